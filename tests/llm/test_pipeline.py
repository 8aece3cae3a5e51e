"""The pipeline's stages, each judged on its own input."""

import random

import pytest

import corpus_pipeline
from tests.llm import brute
from visitlens.llm import secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, `clean` int"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Clean documents, copies, near copies, junk, a contaminated one, secrets, and the awkward rows."""
    rng = random.Random(11)
    words = ["w%s" % chr(97 + rng.randrange(26)) + "".join(rng.choice("aeioust") for _ in range(4)) for _ in range(400)]

    def text(n=90):
        return " ".join(rng.choice(["the", "of", "and", *rng.sample(words, 9)]) for _ in range(n))

    clean = [text() for _ in range(60)]
    item = text(30)
    secret = text() + " AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)) + " " + text()
    rows = list(enumerate(clean))
    rows += [(100, clean[3]), (101, clean[3]), (102, clean[4] + " more"), (103, text(20) + " " + item + " " + text(20))]
    rows += [(104, secret), (105, "short"), (106, None), (107, ""), (None, text()), (None, clean[5])]
    rows += [(108, "the spam of " * 60), (5, clean[5])]
    for i in range(110, 150):
        rows.append((i, text() + " AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))))
    given = [(i, t, "en", "s", len(t or ""), "x", 1) for i, t in rows]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(given, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), {"clean": clean, "rows": rows}


def test_stages(spark, tables):
    folder, made = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, folder))
        if name != "byte_bpe":
            assert out.dtypes == docs.dtypes
        kept[name] = out.collect()
        docs = out
    after = {name: [(r.doc_id, r.text) for r in rows] for name, rows in kept.items() if name != "byte_bpe"}
    ids = {name: [r.doc_id for r in rows] for name, rows in kept.items()}
    assert not {105, 106, 107, 108} & set(ids["quality_rules"])
    assert set(range(60)) | {100, 103, 104, None} <= set(ids["quality_rules"])
    # One of each group of near-duplicates, all others as they were.
    texts = sorted(after["quality_rules"], key=lambda r: (r[0] is None, r[0] or 0))
    values = [brute.fingerprint(t) for _, t in texts]
    roots = brute.linked(values, lambda a, b: bin(a ^ b).count("1") <= 3)
    wanted = [texts[i] for i in sorted(set(roots))]
    assert brute.ordered(after["near_duplicates"]) == brute.ordered(wanted)
    assert not {100, 101} & set(ids["near_duplicates"]) and ids["near_duplicates"].count(5) == 1
    gone = set(ids["near_duplicates"]) - set(ids["decontamination"])
    assert gone == {103}
    scanned = dict(after["secret_scans"])
    assert len(ids["secret_scans"]) == len(ids["decontamination"])
    assert secrets.MARK in scanned[104] and "AKIA" not in scanned[104]
    assert all(scanned[i] == made["clean"][i] for i in range(60) if i in scanned)
    assert all(r.n_chars == len(r.text) for r in kept["secret_scans"])
    for r in kept["byte_bpe"]:
        if r.doc_id is not None:
            assert r.decoded_sha256 == brute.sha(scanned[r.doc_id]) and r.n_tokens == len(r.token_ids) > 0


def test_run_is_the_stages_in_turn(spark, tables):
    folder, _ = tables
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "n_tokens", "token_ids", "decoded_sha256"]
    assert found.count() > 60


def test_an_id_may_have_rows_in_many_groups(spark):
    """The copy of an id goes and its other text stays; of an id's near texts one stays."""
    rng = random.Random(12)
    x, y, z = (" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(80)) for _ in range(3))
    rows = [(3, x), (5, x), (5, z), (6, y), (6, y.upper()), (6, y), (7, z), (None, x), (None, z)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "x", 1) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert brute.ordered((r.doc_id, r.text) for r in kept) == brute.ordered([(3, x), (5, z), (6, y.upper())])
