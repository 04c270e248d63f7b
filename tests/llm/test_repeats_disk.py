"""What the search for repeats keeps on disk: tokens only of fragments that are compared, and shuffle files of the running step."""

import gc
import random
import time

import pytest
from test_operators import byte_repeats, sorted_rows

from pairloom.llm import repeats, suffixarray
from pairloom.session import drop_shuffles

COLUMNS = "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"


def passages(seed=5):
    """Texts that share one long passage between ends of their own, and equal rows among them."""
    draw = random.Random(seed)
    some = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    shared = some(3000)
    rows = [(i, some(150) + shared[draw.randrange(40) : 2900 + i] + some(150)) for i in range(12)]
    return rows + rows[:4] + [(20, rows[5][1]), (21, some(400)), (22, None), (23, "")]


@pytest.mark.parametrize("group", [512, 1])
def test_equal_rows_among_texts_that_overlap(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted_rows(suffixarray.remove_repeats(docs), *COLUMNS) == byte_repeats(rows, 100)


def test_only_fragments_that_are_compared_hold_tokens(spark, monkeypatch):
    tables, stored = {}, repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda df, name="table": tables.update({name: (out := stored(df, name))}) or out)
    docs = spark.createDataFrame(sorted(set(passages()), key=str), "doc_id long, text string").repartition(3)
    suffixarray.remove_repeats(docs)
    held = {name for name, df in tables.items() if any(kind == "binary" for _, kind in df.dtypes)}
    assert held == {"bodies"}
    several = tables["unified"].groupBy("run").count().where("count > 1").select("run")
    compared = tables["unified"].join(several, "run").count()
    assert tables["bodies"].count() == compared < tables["unified"].count() < tables["fragments"].count()


def test_shuffle_files_of_past_jobs_go(spark):
    files = lambda: spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().size()
    drop_shuffles(spark)
    spark.range(100000).repartition(20).write.format("noop").mode("overwrite").save()
    gc.collect()
    held, until = files(), time.time() + 20
    drop_shuffles(spark)
    while files() >= held and time.time() < until:
        time.sleep(0.2)
    assert 0 <= files() < held
