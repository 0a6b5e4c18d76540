
from titlepulse.operators import ingest as I
from titlepulse.schemas import ACTOR
from titlepulse.sources.streams import json_table, kafka_options, kafka_sink_rows
from titlepulse.streaming.sinks import jdbc_batch_writer, jdbc_options


def test_kafka_options():
    o = kafka_options("movie", bootstrap="broker:9092", max_offsets_per_trigger=100)
    assert o == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "movie",
                 "startingOffsets": "earliest", "maxOffsetsPerTrigger": "100"}


def test_kafka_sink_rows(spark):
    df = spark.createDataFrame([("k", "[]", "movie")], "key string, value string, topic string")
    assert kafka_sink_rows(df).columns == ["key", "value", "topic"]
    assert kafka_sink_rows(df, "actor").first().topic == "actor"


def test_json_table_declared_schema(spark, tmp_path):
    p = str(tmp_path / "actors.json")
    with open(p, "w") as f:
        f.write('{"actor_id": "A01", "director": "D", "writers": ["A B", "C"], "stars": ["X"], "movie_id": "tt1"}\n')
    row = json_table(spark, p, ACTOR).first()
    assert row.writers == '["A B", "C"]'  # the raw JSON text, as written


def test_page_fields_and_url(spark):
    html = ('<html lang="en"><head><title> T1 </title></head><body><a href="/x">x</a>'
            '<a class="c" href="/y">y</a><article><h1>H</h1><p>ab <b>c</b></p></article></body></html>')
    df = spark.createDataFrame([(1, "https://h.example.com/title/tt9/?ref=a", html)],
                               "page_id long, url string, html string")
    r = I.page_fields(df).first()
    assert (r.title, r.h1, r.lang, r.n_links, r.article_chars) == ("T1", "H", "en", 2, 5)
    u = I.url_parts(df).first()
    assert (u.url_base, u.path_id, u.host) == ("https://h.example.com/title/tt9/", "tt9", "h.example.com")


def test_list_ops(spark):
    df = spark.createDataFrame([("A1", "D", '["W1","S1"]', '["S1","S2"]')],
                               "actor_id string, director string, writers string, stars string")
    r = I.list_ops(df).first()
    assert (r.top_stars, r.writers_wo_lead, r.star_3, r.n_stars) == ("S1|S2", "W1", None, 2)


def test_jdbc_append_with_derby(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path / 'db'};create=true"
    opts = jdbc_options(url, "TOP_COUNTRY", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    w = jdbc_batch_writer(opts)
    df = spark.createDataFrame([("US", 2)], "country string, total_movie long")
    w(df, 0)
    w(df, 1)
    back = spark.read.format("jdbc").options(**opts).load()
    assert sorted(r.BATCH_ID if "BATCH_ID" in back.columns else r.batch_id for r in back.collect()) == [0, 1]


def test_broker_topic_needs_the_kafka_connector(spark):
    import pytest
    from titlepulse.streaming.jobs import load_topic
    with pytest.raises(Exception) as err:
        load_topic(spark, "movie", "movie", bootstrap="broker:9092")
    assert "kafka" in str(err.value).lower()
