import collections
import json
import os
import random

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from encore import sources
from encore.session import SMALL_PART, small_tasks
from encore.sources import schemas


def write_json(folder, *docs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "a.json"), "w") as f:
        f.write("\n".join(json.dumps(d) for d in docs))
    return str(folder)


def test_recordings(spark, tmp_path):
    artist = {"name": "N", "type": None, "country": "", "life-span": {"begin": "1970-01"}}
    release = {"date": "1999-05", "release-group": {"primary-type": "Album"}}
    path = write_json(
        tmp_path / "r",
        {"id": "1", "title": "t", "length": 5, "disambiguation": "live", "genre": "pop",
         "releases": [release, {"date": "2001"}], "artist-credit": [{"artist": artist}]},
        {"id": "2", "title": "u", "genre": "pop", "releases": [], "artist-credit": None},
        {"id": "3", "genre": "pop", "releases": [{"date": "", "release-group": None}], "artist-credit": ["and"]},
    )
    payloads = spark.read.schema(schemas.RECORDING_PAYLOAD + ", genre string").json(path)
    got = rows(sources.flatten_recordings(payloads), "mbid")
    assert got[0] == ("1", "t", 5, "pop", "live", "Album", "1999", "N", "Unknown", "Unknown", "1970")
    assert got[1] == ("2", "u", None, "pop", "", "Unknown", None, None, "Unknown", "Unknown", None)
    assert got[2][5:9] == ("Unknown", None, None, "Unknown")


def test_popularity_last_usable_wins(spark, tmp_path):
    def item(i, listens, users):
        return {"recording_mbid": i, "total_listen_count": listens, "total_user_count": users}

    path = write_json(
        tmp_path / "p",
        {"seq": 1, "payload": [item("a", 1, 1), item("b", 2, 1), item("a", 3, 2)]},
        {"seq": 2, "payload": [], "data": [item("b", None, 5), item("", 1, 1), item("c", 9, 9)]},
        {"seq": 3, **item("c", 8, 7)},
    )
    responses = spark.read.schema(schemas.POPULARITY_RESPONSE + ", seq bigint").json(path)
    assert rows(sources.last_popularity(responses, "seq"), "mbid") == [("a", 3, 2), ("b", 2, 1), ("c", 8, 7)]


def test_audio_payload(spark, tmp_path):
    path = write_json(tmp_path / "a", {"mbid": "1", "rhythm": {"bpm": 120.5}, "tonal": {"key_key": "C"}}, {"mbid": "2"})
    payloads = spark.read.schema("mbid string, " + schemas.AUDIO_PAYLOAD).json(path)
    assert rows(sources.flatten_audio(payloads), "mbid") == [
        ("1", 120.5, None, "C", None, None, None),
        ("2", None, None, None, None, None, None),
    ]


def test_corpus_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        'title,artist,lyrics\na,b,"line 1\nline ""2"""\nshort,row\ntoo,many,fields,here\n,x,y\nok,b2,z\n'
    )
    got = rows(sources.read_corpus_csv(spark, str(tmp_path / "c.csv")), "title")
    assert got == [("a", "b", 'line 1\nline "2"'), ("ok", "b2", "z")]


def test_csv_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", 'q"t', None, ["x", "y"])], "s string, t string, n int, l array<string>")
    sources.write_csv(df, str(tmp_path / "o"))
    back = spark.read.option("multiLine", True).option("escape", '"').csv(str(tmp_path / "o"), header=True)
    assert rows(back) == [("a\nb", 'q"t', None, "x; y")]
    sources.write_summary(df, str(tmp_path / "j"))
    assert rows(spark.read.schema(df.schema).json(str(tmp_path / "j"))) == rows(df)


def test_missing_source(spark, tmp_path):
    empty = sources.attribute_rows(spark, None, schemas.AUDIO)
    assert empty.count() == 0 and empty.columns[0] == "mbid"
    with pytest.raises(AnalysisException):
        sources.read_table(spark, str(tmp_path / "none"), schemas.POPULARITY)


def random_corpus(rng, rows):
    """CSV text with line breaks and doubled quotes in fields, blank lines, long and short rows."""

    def field():
        words = [rng.choice(["rain", "é", "a,b", 'say ""hi""', "line\nbreak", "x\r\ny", ""]) for _ in range(rng.randrange(4))]
        text = " ".join(words)
        return f'"{text}"' if set(text) & set(',\n\r"') or rng.random() < 0.3 else text

    out = ["title,artist,lyrics"]
    for _ in range(rows):
        out.append(",".join(field() for _ in range(rng.choice([3, 3, 3, 3, 2, 4, 1]))))
        if rng.random() < 0.1:
            out.append("")
    return rng.choice(["\n", "\r\n"]).join(out) + rng.choice(["", "\n"])


@pytest.mark.parametrize("size", ["37b", "200b", "1m"])
def test_split_corpus_equals_one_task_reader(spark, tmp_path, size):
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        for seed in range(3):
            folder = tmp_path / f"c{seed}"
            folder.mkdir()
            rng = random.Random(seed)
            for n in range(2):
                (folder / f"{n}.csv").write_text(random_corpus(rng, 40), newline="")
            got = sources.read_corpus_csv(spark, str(folder))
            want = sources.read_corpus_csv(spark, str(folder), split=False)
            # The one-task reader turns Windows line ends within fields into \\n; the split one doesn't.
            plain = [collections.Counter(tuple(v.replace("\r\n", "\n") for v in r) for r in rows(df)) for df in (got, want)]
            assert plain[0] == plain[1] and plain[0]
            if size == "37b":
                assert got.rdd.getNumPartitions() > 20
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_split_corpus_record_over_many_ranges(spark, tmp_path):
    long = "word\n" * 3000 + 'and ""quotes""'
    path = tmp_path / "long.csv"
    path.write_text(f'title,artist,lyrics\na,b,"{long}"\nc,d,"e\nf"\n', newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        got = rows(sources.read_corpus_csv(spark, str(path)), "title")
        assert got == [("a", "b", long.replace('""', '"')), ("c", "d", "e\nf")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_staged_shuffles_are_cut_by_size(spark):
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = [spark.conf.get(k, None) for k in keys]

    def parts():
        return spark.range(1_500_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).distinct().rdd.getNumPartitions()

    plain = parts()
    with small_tasks(spark, 400 * SMALL_PART):
        assert spark.conf.get(keys[1]) == "400"
        assert parts() > plain
    assert [spark.conf.get(k, None) for k in keys] == before
