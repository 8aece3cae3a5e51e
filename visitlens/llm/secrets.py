"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are runs of token characters that have a digit, an issuer's format or mixed case,
whatever is assigned to the name of a secret, and private keys in blocks, found in whole texts. A token of an
issuer's format is a secret outright. Each other one is described by its characters (length, transitions
between kinds of characters, how unlike the dictionary's words its neighbouring characters are, shares, the part
that dictionary words cover, signs of a path or of a harmless form) and by the words and characters beside it, and a
forest trained from labelled findings decides. ``scanned`` gives the spans that are secrets and the
text with a mark in their place.

Labelled findings come from a bounded sample of documents, ``SAMPLE_DOCS`` of lowest hash;
``labelled_by_format`` labels those whose issuer's format, assignment or harmless form leaves no
doubt, and no others. What is beside a finding gave many their label, so ``varied`` adds findings that only
characters tell apart: long secrets with nothing beside them, and as written in other alphabets; hexadecimal
digests and ids beside harmless names; and names made of dictionary words. The
dictionary is counted over all documents: the words that make up at least one in
``DICTIONARY_WORDS`` of all pairs of a document and a word in it. So it has at most that many
words, and texts of one kind give one dictionary whatever their number.

Null texts have no candidates and stay null; empty texts stay empty. Without labelled
findings only issuers' formats are secrets. Repeated documents are each scanned. Other columns are kept;
those named like a result are replaced. A text of any length is scanned whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from visitlens.llm import forest
from visitlens.llm.common import stored

MARK = "<SECRET>"
SAMPLE_DOCS = 20_000
DICTIONARY_WORDS = 50_000
BESIDE = 48

CANDIDATE = re.compile(r"[A-Za-z0-9_+/.@\-]{8,}={0,2}")
RUN = re.compile(r"[A-Za-z]{3,}")
WORD = re.compile(r"[A-Za-z]+")
PATH = re.compile(r"/|@|\.[A-Za-z]{2,5}$|\d\.\d")

# Words beside secrets, words beside harmless tokens, and formats of issuers.
KEY_WORDS = frozenset("password passwd pwd token secret key apikey api auth credential credentials access bearer".split())
TAME_WORDS = frozenset(
    "example sample dummy test version license commit sha checksum md digest etag hash revision build "
    "mail phone card order id uuid guid".split()
)
FORMATS = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}"
    r"|gh[pousr]_[0-9A-Za-z]{36}|github_pat_[0-9A-Za-z_]{22,}|glpat-[0-9A-Za-z_\-]{20,}"
    r"|xox[abeoprs]-[0-9A-Za-z\-]{10,}|(?:sk|rk)_(?:live|test)_[0-9A-Za-z]{16,}"
    r"|AIza[0-9A-Za-z_\-]{35}|npm_[0-9A-Za-z]{36}|SG\.[0-9A-Za-z_\-]{16,}\.[0-9A-Za-z_\-]{16,}"
    r"|eyJ[0-9A-Za-z_\-]{8,}\.eyJ[0-9A-Za-z_\-]{8,}\.[0-9A-Za-z_\-]{8,})(?![A-Za-z0-9])"
)
PRIVATE_KEY = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----.*?-----END [A-Z0-9 ]*PRIVATE KEY-----", re.DOTALL)
ASSIGNED = re.compile(r"(?i)(password|passwd|pwd|token|secret|key)[\"']?\s*[:=]\s*[\"']?$")
VALUE = re.compile(
    r"(?i)(?:password|passwd|pwd|token|secret|key)[\"']?\s*[:=]\s*"
    r"(?:\"(?P<a>[^\"\n]+)\"|'(?P<b>[^'\n]+)'|[\"']?(?P<c>[^\s\"',;&<>(){}\[\]]+))"
)
MIXED = re.compile(r"[a-z][A-Z]|[A-Z]{2}[a-z]")
# Patterns, of Java and Python alike, of tokens that are harmless by their form: addresses, numbers, ids, dates.
UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9:.+Z\-]*)?$"
HARMLESS = rf"@|\.[A-Za-z]{{2,5}}(/|$)|[0-9]\.[0-9]|^[0-9+/._\-]+$|{UUID}|{DATE}"
_HARMLESS = re.compile(HARMLESS)
BARE_LEAST = 16

#: Features of a token's characters, then those of what is beside it.
NAMES = (
    "log_length",
    "transitions",
    "surprise",
    "longest_run",
    "digits",
    "upper",
    "distinct",
    "vowels",
    "hexadecimal",
    "dictionary",
    "path",
    "harmless_form",
    "named",
    "assigned",
    "quoted",
    "key_beside",
    "tame_beside",
)
BESIDE_FROM = NAMES.index("named")

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


class Scanner(NamedTuple):
    """What the scan of a text needs: the forest, the dictionary, how unusual neighbouring characters are in it, and
    the least chance."""

    trees: list[forest.Tree]
    dictionary: frozenset[str]
    surprises: np.ndarray
    least: float = 0.5


#: The number of each byte that is a letter, and 26 for others.
_LETTER = np.full(256, 26)
_LETTER[np.arange(97, 123)] = _LETTER[np.arange(65, 91)] = np.arange(26)


def surprises_of(dictionary: frozenset[str]) -> np.ndarray:
    """How many bits each letter after another one tells, if tokens were like the dictionary's words."""
    counts = np.full((27, 27), 0.5)
    for word in dictionary:
        letters = _LETTER[np.frombuffer(word.encode("ascii", "replace"), np.uint8)]
        np.add.at(counts, (letters[:-1], letters[1:]), 1)
    return -np.log2(counts / counts.sum(axis=1, keepdims=True))


def _surprise(codes: np.ndarray, surprises: np.ndarray) -> float:
    """The mean over pairs of letters; without any, 0."""
    letters = _LETTER[codes]
    pairs = (letters[:-1] < 26) & (letters[1:] < 26)
    return float(surprises[letters[:-1][pairs], letters[1:][pairs]].mean()) if pairs.any() else 0.0


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the runs with a digit, an issuer's format or mixed case, without the dots, dashes and
    slashes at their ends."""
    for found in CANDIDATE.finditer(text):
        run = found.group()
        if run.islower() and run.isalpha():
            continue
        start = found.start() + len(run) - len(run.lstrip("./-+"))
        end = found.end() - (len(run) - len(run.rstrip("./-+")))
        own = text[start:end]
        if len(own) >= 8 and (any(c.isdigit() for c in own) or MIXED.search(own) or FORMATS.search(own)):
            yield start, end


def _values(text: str) -> Iterator[tuple[int, int]]:
    """Spans of what is assigned to the name of a secret; unquoted, without the stops at its end."""
    for found in VALUE.finditer(text):
        start, end = found.span(found.lastgroup)
        if found.lastgroup == "c":
            end = start + len(text[start:end].rstrip(".:!?"))
        if end > start:
            yield start, end


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Spans of runs, assigned values and blocks of private keys in order; those that overlap are one."""
    last = None
    blocks_of_keys = [found.span() for found in PRIVATE_KEY.finditer(text)]
    for start, end in sorted([*_runs(text), *_values(text), *blocks_of_keys]):
        if last is not None and start < last[1]:
            last = (last[0], max(end, last[1]))
            continue
        if last is not None:
            yield last
        last = (start, end)
    if last is not None:
        yield last


def issued(token: str) -> bool:
    """Whether a candidate has an issuer's format or is a private key."""
    return FORMATS.search(token) is not None or PRIVATE_KEY.search(token) is not None


def characters(token: str, dictionary: frozenset[str], surprises: np.ndarray) -> list[float]:
    """The features of a token's characters."""
    n = len(token)
    codes = np.frombuffer(token.encode("ascii", "replace"), np.uint8)
    lower, upper = (codes >= 97) & (codes <= 122), (codes >= 65) & (codes <= 90)
    digit = (codes >= 48) & (codes <= 57)
    kind = lower + 2 * upper + 3 * digit
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    runs = np.diff(np.r_[0, change, n])
    letters = int(lower.sum() + upper.sum())
    covered = sum(len(w) for w in RUN.findall(token) if w.lower() in dictionary)
    return [
        float(np.log2(n)),
        len(change) / max(1, n - 1),
        _surprise(codes, surprises),
        float(runs.max()) / n,
        float(digit.mean()),
        float(upper.mean()),
        len(set(token)) / min(n, 64),
        sum(token.count(c) for c in "aeiouAEIOU") / max(1, letters),
        float(all(c in "0123456789abcdef" for c in token.lower())),
        covered / n,
        float(PATH.search(token) is not None),
        float(_HARMLESS.search(token) is not None),
    ]


def beside(before: str, after: str) -> list[float]:
    """The features of the characters before and after a token."""
    near = {w.lower() for w in WORD.findall(before)[-4:]}
    around = near | {w.lower() for w in WORD.findall(after)[:2]}
    return [
        float(ASSIGNED.search(before) is not None),
        float(before.rstrip(" \"'")[-1:] in ("=", ":")),
        float(before[-1:] in ("\"", "'")),
        float(bool(near & KEY_WORDS)),
        float(bool(around & TAME_WORDS)),
    ]


def described(text: str, start: int, end: int, dictionary: frozenset[str], surprises: np.ndarray) -> list[float]:
    """The features of a candidate, in the order of ``NAMES``."""
    own = characters(text[start:end], dictionary, surprises)
    return own + beside(text[max(0, start - BESIDE) : start], text[end : end + BESIDE])


def _sample(docs: DataFrame, id_column: str, text: str, most: int) -> DataFrame:
    """Texts of the ids of lowest hash; only the bounded list of ids is sent to all tasks."""
    ids = docs.filter(f"`{id_column}` is not null").select(F.col(id_column).alias("_id")).distinct()
    chosen = ids.orderBy(F.xxhash64("_id", F.lit(5)), "_id").limit(most)
    given = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("text")).filter("text is not null")
    return given.join(F.broadcast(chosen), "_id", "left_semi").select("text")


def dictionary_of(texts: DataFrame, most: int = DICTIONARY_WORDS) -> frozenset[str]:
    """The words of three letters and more whose share of all pairs of a text and a word in it is
    one in ``most`` or higher, which at most ``most`` words can have; they are in two texts at least."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0)))
    counted = stored(texts.select(F.explode(words).alias("word")).groupBy("word").count())
    pairs = counted.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    rows = counted.filter(F.col("count") * most >= pairs).filter("count > 1").select("word").collect()
    return frozenset(row.word for row in rows)


def findings(texts: DataFrame, dictionary: frozenset[str], surprises: np.ndarray) -> DataFrame:
    """token, ``before`` (the characters beside it) and features of all candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ([], [], [])
            for text in batch.column(0).to_pylist():
                for start, end in candidates(text or ""):
                    rows[0].append(text[start:end])
                    rows[1].append(text[max(0, start - BESIDE) : start])
                    rows[2].append(described(text, start, end, dictionary, surprises))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.list_(pa.float64()))],
                names=["token", "before", "features"],
            )

    return texts.select("text").mapInArrow(run, "token string, before string, features array<double>")


def labelled_by_format(found: DataFrame) -> DataFrame:
    """Findings with ``label``: 1 if the token has an issuer's format, or is assigned to a name of
    a secret and not of dictionary words; 0 if it is not assigned, has no word of a secret beside it
    and is harmless by its form, of dictionary words, beside a harmless word, or short, or if it
    is an unquoted dictionary word after a colon and a space, as in prose. Others have none."""
    feature = {name: F.col("features")[i] for i, name in enumerate(NAMES)}
    token = F.col("token")
    has_format = token.rlike(FORMATS.pattern) | token.rlike(f"(?s){PRIVATE_KEY.pattern}")
    named = F.col("before").rlike(ASSIGNED.pattern)
    letters = F.length(F.regexp_replace(token, "[^A-Za-z]|(?<![A-Za-z])[A-Za-z]{1,2}(?![A-Za-z])", ""))
    wordy = ~token.rlike("[0-9]") & (F.round(feature["dictionary"] * F.length("token")) >= letters)
    form = token.rlike(HARMLESS) | wordy | (feature["tame_beside"] > 0) | (F.length("token") < BARE_LEAST)
    harmless = ~named & (feature["key_beside"] == 0) & form
    prose = named & wordy & F.col("before").rlike(":\\s+$")
    label = F.when(has_format | (named & ~wordy), 1).when(harmless | prose, 0)
    return found.withColumn("label", label)


def _rewritten(token: str) -> Iterator[str]:
    """A secret's digests in other alphabets, in lengths from 20 to 64."""
    for turn in (b"0", b"1", b"2"):
        digest = hashlib.sha256(turn + token.encode()).digest()
        size = 20 + digest[0] % 21
        plain = base64.b64encode(digest + digest[::-1]).decode()
        yield digest.hex()[: (32, 40, 64)[digest[1] % 3]]
        yield plain.replace("+", "").replace("/", "")[:size]
        yield plain.replace("+", "-").replace("/", "_")[:size]
        yield plain[:size]
        yield base64.b32encode(digest).decode()[:size]
        yield base64.b32encode(digest[::-1]).decode().lower()[:size]


def _digests(token: str) -> list[str]:
    """Digests of usual lengths, and an id in groups, of any token."""
    digest = hashlib.sha512(token.encode()).hexdigest()
    groups = "-".join((digest[:8], digest[8:12], digest[12:16], digest[16:20], digest[20:32]))
    return [digest[: (32, 40, 64, 128)[int(digest[-1], 16) % 4]], groups]


def _made_of(words: list[str], token: str) -> list[str]:
    """Names as they are written in code, paths and addresses: of dictionary words, and of blends of them, which
    stand for words that the dictionary lacks."""
    if not words:
        return []
    digest = hashlib.sha256(token.encode()).digest()
    own = [words[int.from_bytes(digest[i : i + 4], "big") % len(words)] for i in (0, 4, 8)]
    blends = [a[: (len(a) + 1) // 2] + b[len(b) // 2 :] for a, b in zip(own, [*own[1:], own[0]])]
    number = str(10_000 + int.from_bytes(digest[12:14], "big"))
    made = []
    for a, b, c in (own, blends):
        made += [
            a + b.title() + c.title() + number[:2],
            a.title() + b.title(),
            f"{a}_{b}_{c}{number[-1]}",
            f"{a}-{b}-{c}-{number}",
            f"{a}/{b}/{c}{number[:1]}.txt",
            f"{a}/{b}{number[:1]}.{number[-2:]}/{c}",
            f"{a}.{b}{number[:3]}.org/{c}",
            f"www.{a}{number[:2]}.com/{b}/{c}{number[-2:]}.html",
            f"{a}{number[:2]}@{b}.{c}.com",
        ]
    return made


def varied(labelled: DataFrame, dictionary: frozenset[str], surprises: np.ndarray) -> DataFrame:
    """Features and label of labelled findings (token, features, label) and of those made of them: long secrets
    with nothing beside them, also in other alphabets; digests and ids beside harmless names; and names made of words
    with nothing or an assignment beside them."""
    listed = sorted(dictionary)
    nothing = [0.0] * (len(NAMES) - BESIDE_FROM)
    # named, assigned, quoted, key_beside, tame_beside
    tame, tame_assigned, other_assigned = [0.0, 0.0, 0.0, 0.0, 1.0], [0.0, 1.0, 0.0, 0.0, 1.0], [0.0, 1.0, 0.0, 0.0, 0.0]

    def of(token: str, label: int) -> Iterator[tuple[list[float], int]]:
        def row(made: str, context: list[float], own: int) -> tuple[list[float], int]:
            return characters(made, dictionary, surprises) + context, own

        if label and len(token) >= BARE_LEAST and not _HARMLESS.search(token):
            for made in (token, *_rewritten(token)):
                yield row(made, nothing, 1)
            for made in _digests(token):
                yield row(made, tame, 0)
                yield row(made, tame_assigned, 0)
        if not label:
            made = _digests(token)
            yield row(made[0], tame_assigned, 0)
            yield row(made[1], nothing, 0)
            for i, made in enumerate(_made_of(listed, token)):
                yield row(made, other_assigned if (len(token) + i) % 4 == 0 else nothing, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for token, features, label in zip(*(column.to_pylist() for column in batch.columns)):
                rows.append((features, label))
                rows.extend(of(token, label))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in rows], pa.list_(pa.float64())), pa.array([y for _, y in rows], pa.int32())],
                names=["features", "label"],
            )

    given = labelled.select("token", "features", F.col("label").cast("int").alias("label"))
    return given.mapInArrow(run, "features array<double>, label int")


def trained(docs: DataFrame, text: str = "text", id_column: str = "doc_id", sample: int = SAMPLE_DOCS) -> Scanner:
    """A scanner with the dictionary of all documents, and a forest from a bounded sample of them
    labelled by format."""
    dictionary = dictionary_of(docs.select(F.col(text).alias("text")))
    surprises = surprises_of(dictionary)
    texts = _sample(docs, id_column, text, sample)
    found = findings(texts, dictionary, surprises)
    labelled = labelled_by_format(found).filter("label is not null").dropDuplicates(["token", "features"])
    return Scanner(forest.train(varied(labelled, dictionary, surprises)), dictionary, surprises)


def scanned(docs: DataFrame, scanner: Scanner, text: str = "text") -> DataFrame:
    """``docs`` with ``n_candidates``, ``secret_spans`` in code points, and ``clean``, the text
    with ``MARK`` in place of each secret."""
    fields = [
        T.StructField("n_candidates", T.LongType()),
        T.StructField("secret_spans", T.ArrayType(SPAN)),
        T.StructField("clean", T.StringType()),
    ]
    made = {field.name for field in fields}
    rest = [field for field in docs.schema if field.name not in made or field.name == text]
    given = docs.select(*[F.col(f"`{field.name}`") for field in rest])
    names = to_arrow_schema(given.schema).names
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            spans = [(i, *span) for i, value in enumerate(texts) for span in candidates(value or "")]
            about = [described(texts[i], a, b, scanner.dictionary, scanner.surprises) for i, a, b in spans]
            chances = forest.chance(scanner.trees, np.array(about).reshape(-1, len(NAMES)))
            counts = np.bincount([i for i, _, _ in spans], minlength=len(texts)) if spans else np.zeros(len(texts), int)
            secret: list[list[dict]] = [[] for _ in texts]
            for (i, a, b), chance in zip(spans, chances):
                if chance >= scanner.least or issued(texts[i][a:b]):
                    secret[i].append({"start": a, "end": b})
            clean = []
            for value, own in zip(texts, secret):
                if own:
                    ends = [0, *(s["end"] for s in own)]
                    starts = [*(s["start"] for s in own), len(value)]
                    value = MARK.join(value[a:b] for a, b in zip(ends, starts))
                clean.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(counts.astype(np.int64)),
                    pa.array(secret, _ARROW_SPANS),
                    pa.array(clean, pa.string()),
                ],
                names=[*names, "n_candidates", "secret_spans", "clean"],
            )

    return given.mapInArrow(run, T.StructType([*rest, *fields]))
