"""Periodic runs against brute force: every period of every text, and the query with its planted runs."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from visitlens.llm import periodic_runs
from visitlens.llm.queries import op13_periodic_runs

SCHEMA = "doc_id long, text string"


def runs_of(words):
    """Maximal stretches of each period; longer periods of a stretch that has a shorter one are left out."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def wanted(doc_id, text, planted=False):
    words = brute.WORD.findall(text or "")
    n = len(words)
    if planted and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return runs_of(words), collapsed(words, runs_of(words)), n


def texts(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(6)):
            part = [rng.choice(["a", "b", "ä|", "a b"]) for _ in range(rng.randrange(1, rng.choice([3, 9, 40])))]
            words += part * rng.choice([1, 1, 3, 4, 5, 9])
            words += part[: rng.randrange(len(part) + 1)]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


def awkward(seed):
    rng = random.Random(seed)
    long = ["w%d" % rng.randrange(50) for _ in range(900)]
    rows = texts(seed, 150)
    rows += [(500, " ".join(long * 4 + long[:17])), (501, " ".join(long * 4)), (502, " ".join(long * 3)), (503, "a " * 5000)]
    rows += [(504, " ".join(["x y " * 700, "z", "x y " * 700])), (505, None), (506, ""), (507, " \n\t "), (None, "b " * 6)]
    rows += [(None, None), (3, rows[3][1]), (3, rows[3][1]), (508, "a a " * 8), (509, "a b c d e f")]
    return rows


def test_matches_brute_force(spark):
    rows = awkward(1)
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA + ", runs int, start string")
    found = periodic_runs.found(docs).collect()
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed.decode(), r.n_words, r.start) for r in found]
    assert brute.ordered(got) == brute.ordered((i, *wanted(i, text), "x") for i, text in rows)
    assert sum(map(len, (r.runs for r in found))) > 100


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=3), st.integers(1, 9))
def test_any_rows_of_numbers(parts, times):
    texts_ = [part * times for part in parts]
    numbers = []
    for i, text in enumerate(texts_):
        numbers += [x + len(texts_) + 1 for x in text] + [i + 1]
    found = list(zip(*periodic_runs.runs_of(np.array([*numbers, 0]))))
    begin, expected = 0, []
    for text in texts_:
        expected += [(a + begin, n, q) for a, n, q in runs_of(text)]
        begin += len(text) + 1
    assert found == expected


def test_range_successor():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 64, 300):
        values = rng.permutation(n)
        low, high = np.sort(rng.integers(0, n + 1, (2, 200)), axis=0)
        bound = rng.integers(0, n, 200)
        inside = [[v for v in values[a:b] if v >= c] for a, b, c in zip(low, high, bound)]
        found = periodic_runs.RangeSuccessor(values)(low, high, bound, -1)
        assert found.tolist() == [min(x, default=-1) for x in inside]


@pytest.mark.parametrize("rows", [awkward(2), []])
def test_query(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    expected = []
    for i, text in rows:
        runs, kept, _ = wanted(i, text, planted=True)
        best = min(((-n, a, q) for a, n, q in runs), default=None)
        head = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        listed = "".join("%d,%d,%d\n" % x for x in runs)
        expected.append((i, len(runs), *head, brute.sha(listed), brute.sha(kept)))
    found = op13_periodic_runs(spark, str(tmp_path))
    assert [t for _, t in found.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert brute.ordered(map(tuple, found.collect())) == brute.ordered(expected)
