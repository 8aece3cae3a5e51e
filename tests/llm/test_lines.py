"""Line dedup against brute force, in batches and over several days."""

import random
import re

import pytest

from tests.llm import brute
from visitlens.llm import line_dedup
from visitlens.sinks.shared import shared_folder

SCHEMA = "doc_id long, text string"


def key_of(line):
    return brute.lower(re.sub("^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))


def deduped(rows, least=10):
    def order(doc_id):
        return 1 << 63 if doc_id is None else doc_id

    first = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            first[key_of(line)] = min(first.get(key_of(line), 1 << 64), order(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < least or first[key_of(x)] == order(doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return brute.ordered(out)


def documents(seed, n=120):
    rng = random.Random(seed)
    pool = ["line number %d of all" % i for i in range(40)] + ["short", "Ünï cödé", "", " \t ", "é" * 10, "É" * 10]
    pool += ["  LINE number 3 of all\t", "line number 3 of all\r", "ab cd ef gh ij", "x" * 5000]
    rows = [(rng.randrange(n * 2), "\n".join(rng.choice(pool) for _ in range(rng.randrange(9)))) for _ in range(n)]
    hot = "a line that very many documents have"
    rows += [(i, f"{hot}\nown line of {i}\n{hot}") for i in range(1000, 1000 + n)]
    rows += [(None, None), (None, hot), (None, "the last line\n" + hot), (None, hot), (3, ""), (4, None), (5, "\n\n\n")]
    rows += [(7, "a line of one id only"), (7, "a line of one id only\n" + hot), (7, "a line of one id only")]
    rows += [(8, "\n".join("very long text %d" % (i % 2500) for i in range(6000)))]
    rng.shuffle(rows)
    return rows


def result(found):
    return brute.ordered((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found.collect())


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_matches_brute_force(spark, batches):
    rows = documents(1)
    docs = spark.createDataFrame([(*row, 1, 2) for row in rows], SCHEMA + ", h int, first int").repartition(5)
    assert result(line_dedup.deduped(docs, batches)) == deduped(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("visitlens_run")]


def test_an_index_is_kept_between_days(spark):
    rows = sorted(documents(2), key=lambda row: 1 << 63 if row[0] is None else row[0])
    cuts = [0, 50, 130, 131, len(rows)]
    # Rows of one id belong to one day.
    cuts = [next((i for i in range(c, len(rows)) if c == 0 or rows[i][0] != rows[i - 1][0]), c) for c in cuts[:-1]] + cuts[-1:]
    folder = shared_folder(spark)
    got = []
    for day, (low, high) in enumerate(zip(cuts, cuts[1:])):
        index = line_dedup.LineIndex(spark, folder, buckets=3) if day == 0 else line_dedup.LineIndex.opened(spark, folder)
        got += result(line_dedup.deduped(spark.createDataFrame(rows[low:high], SCHEMA), 2, index=index))
        index.close()
    assert brute.ordered(got) == deduped(rows)


def test_runs_are_levelled_and_hold_each_hash_once(spark):
    index = line_dedup.LineIndex(spark, shared_folder(spark), buckets=4, fanout=2)
    for day in range(5):
        rows = [(day, "\n".join("a line of number %d" % i for i in range(day * 3, day * 3 + 6)))]
        index.add(line_dedup.hashed_lines(line_dedup.keyed(spark.createDataFrame(rows, SCHEMA), "text", "doc_id")))
    assert [len(held) for held in index.levels] == [1, 0, 1]
    held = [r.h for run in index.runs for r in spark.table(run).collect()]
    assert len(held) == len(set(held)) == 18
    for run in index.runs:
        assert "Bucket" in str(spark.sql(f"DESCRIBE EXTENDED {run}").collect())
    index.close()


def test_runs_are_merged_with_a_batch_without_dealing_them_out(spark):
    index = line_dedup.LineIndex(spark, shared_folder(spark), buckets=8)
    lines = line_dedup.hashed_lines(line_dedup.keyed(spark.createDataFrame(documents(3), SCHEMA), "text", "doc_id"))
    index.add(lines)
    plan = index.unseen(lines.groupBy("h").count())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert plan.count("Exchange") == 1 and "Python" not in plan
    index.close()


def test_no_rows(spark):
    assert line_dedup.deduped(spark.createDataFrame([], SCHEMA)).collect() == []
