"""The triplet source: ranges of bytes, filters that are pushed, writes that are whole or not there."""

import io
import json
import random
import string
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cellgrain.sources import triplet_source as ts

COLS = ["sample_id", "gene_id", "cell_id", "value"]


@pytest.fixture
def source(spark):
    ts.register(spark)
    return spark


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*COLS).collect())


def save(df, path, mode="append", **options):
    df.write.format("triplets").mode(mode).options(**options).save(str(path))


def load(spark, path, **options):
    return spark.read.format("triplets").options(**options).load(str(path))


def made(spark, n=3000, seed=0):
    rng = random.Random(seed)
    name = lambda: "".join(rng.choices(string.ascii_letters + "-.é猫 ", k=rng.randint(1, 40))) + "x"
    genes = [name() for _ in range(40)] + ["NA", "null", "nan", "1", "true"]
    rows = [(f"s/{rng.randint(0, 3)}", rng.choice(genes), name(), rng.choice([0.1, 1 / 3, 5.0, -1e-300, 1e300, rng.random()])) for _ in range(n)]
    return rows + rows[:50], genes


@pytest.mark.parametrize("size", [0, 1, 7, 100, 4096])
def test_each_line_belongs_to_one_range(size):
    rng = random.Random(size)
    text = "".join("a" * rng.choice([0, 1, 5, 300]) + "\n" for _ in range(200))[: None if size % 2 else -1].encode()

    class File(io.BytesIO):
        pass

    for step in (1, 3, 1 << 20):
        parts = [b"".join(ts.whole_lines(File(text), at, min(at + max(size, 13), len(text)), step)) for at in range(0, len(text), max(size, 13))]
        assert b"".join(parts) == text


@pytest.mark.parametrize("split", [11, 1000, 1 << 26])
def test_round_trip_at_any_range(source, tmp_path, split):
    rows, _ = made(source, 300 if split == 11 else 3000)
    save(source.createDataFrame(rows, ts.SCHEMA).repartition(3).select("value", "cell_id", "sample_id", "gene_id"), tmp_path / "d")
    split = max(split, sum(f["bytes"] for f in ts.manifest(str(tmp_path / "d"))) // 60)
    back = load(source, tmp_path / "d", splitBytes=split)
    assert rows_of(back) == Counter(rows)
    assert back.rdd.getNumPartitions() >= (4 if split > 1 << 20 else 20)


def test_chosen_samples_and_genes(source, tmp_path):
    rows, genes = made(source)
    path = str(tmp_path / "d")
    ts.write(source.createDataFrame(rows, ts.SCHEMA), path)
    back = ts.read(source, path)
    some = ts.read(source, path, ["s/1", "s/2"], [genes[0], "NA"])
    assert rows_of(some) == Counter(r for r in rows if r[0] in ("s/1", "s/2") and r[1] in (genes[0], "NA"))
    assert some.rdd.getNumPartitions() < back.rdd.getNumPartitions()
    assert rows_of(ts.read(source, path, genes=[])) == rows_of(ts.read(source, path, ["none"])) == Counter()


@pytest.mark.parametrize("push", ["false", "true"])
def test_filters_of_one_plan_dont_reach_another(source, tmp_path, push):
    rows, _ = made(source, 300)
    path = str(tmp_path / "d")
    ts.write(source.createDataFrame(rows, ts.SCHEMA), path)
    source.conf.set("spark.sql.python.filterPushdown.enabled", push)
    try:
        back = ts.read(source, path)
        for wanted in ("sample_id = 's/1'", "gene_id = 'NA' or sample_id = 's/0'", "value > 0", "true"):
            assert back.where(wanted).count() == ts.read(source, path).where(wanted).count()
        assert back.count() == len(rows)
    finally:
        source.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_appends_and_overwrites(source, tmp_path):
    a = source.createDataFrame([("s", "g", "c", 1.0), ("s", "g", "c", 1.0)], ts.SCHEMA)
    save(a, tmp_path / "d")
    save(a.limit(1), tmp_path / "d")
    assert load(source, tmp_path / "d").count() == 3
    save(a.limit(1), tmp_path / "d", "overwrite")
    assert load(source, tmp_path / "d").count() == 1
    save(a.limit(0), tmp_path / "d", "overwrite")
    assert load(source, tmp_path / "d").count() == 0


def test_a_cut_off_write_is_never_read(source, tmp_path):
    good = source.createDataFrame([("s", "g", "c", 1.0)], ts.SCHEMA)
    save(good, tmp_path / "d")
    # One task writes its file, another fails: the write isn't published, before and after it the first row is there.
    bad = source.range(0, 2000, 1, 2).select(F.lit("s").alias("sample_id"), F.when(F.col("id") < 1999, F.lit("h")).alias("gene_id"), F.col("id").cast("string").alias("cell_id"), F.lit(1.0).alias("value"))
    with pytest.raises(Exception, match="gene_id has nulls"):
        save(bad, tmp_path / "d")
    # Files that a lost driver left behind, and a manifest that wasn't renamed.
    (tmp_path / "d/data/left.tsv").write_text("h\tc\t1.0\n")
    (tmp_path / "d/_draft.json").write_text(json.dumps({"files": [{"sample": "s", "name": "data/left.tsv", "rows": 1, "bytes": 8}]}))
    assert rows_of(load(source, tmp_path / "d")) == Counter([("s", "g", "c", 1.0)])


@pytest.mark.parametrize("name", ["", "a\tb", "a\nb", "a\rb", 'a"b'])
def test_names_that_no_line_holds(source, tmp_path, name):
    for row in (("s", name, "c", 1.0), ("s", "g", name, 1.0)):
        with pytest.raises(Exception, match="empty name, or one with a tab"):
            save(source.createDataFrame([row], ts.SCHEMA), tmp_path / "d")
    assert not Path(tmp_path / "d/_manifest.json").exists()


def test_missing_and_odd_folders(source, tmp_path):
    with pytest.raises(Exception, match="no triplets are published"):
        load(source, tmp_path / "none").count()
    with pytest.raises(Exception, match="aren't"):
        save(source.createDataFrame([("s", "g", "c", 1.0, 2)], f"{ts.SCHEMA}, extra int"), tmp_path / "d")
