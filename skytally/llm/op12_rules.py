"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger keeps what was measured and one bit per failed rule, so
a policy (a named, versioned set of rules) is a mask: a document is kept if none of the policy's bits is set.
New policies, and the ablations of old ones, read the ledger and never the texts again.

Words are runs without the six ASCII blanks. A word without a letter has ASCII characters only and none of
A-Z, a-z; a word in capitals has two or more of A-Z and no a-z. Lines are split at \\n and counted if they hold a
word; one of them is a duplicate if it equals an earlier line of its text. Three-word windows are compared
word by word, not by hash.

Defined results: a null or empty text measures zero everywhere and fails ``few_words`` alone; repeated rows
are judged each; a null id is returned as null; an empty table gives an empty result; other columns are
ignored, whatever their names, unless named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skytally.llm import common as C
from skytally.llm.shingles import batches

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letterless_words",
            "n_capital_words", "n_exclamations", "n_ellipsis_lines", "n_bullet_lines"]

#: A rule's place is its bit in every ledger: add rules at the end, never reorder. SQL over the measures.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "letterless_words": "5 * n_letterless_words > n_words",
    "capital_words": "10 * n_capital_words > 3 * n_words",
    "exclamations": "10 * n_exclamations > n_words",
    "ellipsis_lines": "10 * n_ellipsis_lines > 3 * n_lines",
    "bullet_lines": "10 * n_bullet_lines > 9 * n_lines",
    "many_duplicate_lines": "10 * n_dup_lines > n_lines",
    "few_words_strict": "n_words < 100",
}
BITS = {name: k for k, name in enumerate(RULES)}
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << BITS[r] for r in self.rules)


#: Versions are never edited once used; a change is a new version.
POLICIES = [
    Policy("base", 1, BASE),
    Policy("prose", 1, (*BASE, "short_words", "long_words", "symbols", "duplicate_lines", "letterless_words",
                        "ellipsis_lines", "bullet_lines")),
    # repeated lines are left to deduplication: short texts with a license line or two fail that rule alone
    Policy("prose", 2, (*BASE, "short_words", "long_words", "symbols", "letterless_words", "capital_words", "exclamations",
                        "ellipsis_lines", "bullet_lines")),
    Policy("strict", 1, (*BASE, "short_words", "long_words", "symbols", "letterless_words", "capital_words", "exclamations",
                         "ellipsis_lines", "bullet_lines", "many_duplicate_lines", "few_words_strict")),
]


def policy(name: str, version: int | None = None) -> Policy:
    """The named policy; its newest version unless one is asked for."""
    found = [p for p in POLICIES if p.name == name and version in (None, p.version)]
    if not found:
        raise ValueError(f"no policy {name!r} of version {version}")
    return max(found, key=lambda p: p.version)


# ---------------------------------------------------------------- measuring

_BLANK, _SYMBOL, _LOWER, _CAPITAL, _LETTER, _EXCLAMATION = (1 << k for k in range(6))
_KIND = np.zeros(256, np.uint8)
for _chars, _flag in ((b" \t\n\x0b\x0c\r", _BLANK), (b"#*$%&|<>", _SYMBOL), (b"!", _EXCLAMATION),
                      (bytes(range(97, 123)), _LOWER | _LETTER), (bytes(range(65, 91)), _CAPITAL | _LETTER),
                      (bytes(range(128, 256)), _LETTER)):
    _KIND[list(_chars)] |= _flag
_ELLIPSES = (b"...", "…".encode())
_BULLETS = (b"-", b"*", "•".encode())


class _Numbers(dict):
    """Numbers for words, in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def repeated_words(words: list[bytes], doc: np.ndarray) -> np.ndarray:
    """Which words stand in a three-word window that occurs twice or more in their text."""
    hit = np.zeros(len(words), bool)
    n = len(words) - 2
    if n < 1:
        return hit
    known = _Numbers()
    ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    # dense numbers of pairs, then of triples: products stay below 2^62 and nothing is hashed
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    triples = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True)[1]
    at = np.flatnonzero(doc[:n] == doc[2:])
    key = doc[at].astype(np.int64) * (int(triples.max()) + 1) + triples[at]
    order = np.argsort(key, kind="stable")
    key = key[order]
    twice = np.zeros(len(key), bool)
    same = key[1:] == key[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    starts = at[order[twice]]
    for k in range(3):
        hit[starts + k] = True
    return hit


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The measures of UTF-8 texts, as arrays in ``MEASURES``' order."""
    n = len(texts)
    words: list[bytes] = []
    counts = np.zeros(n, np.int64)
    lines, repeats, ellipses, bullets = (np.zeros(n, np.int64) for _ in range(4))
    for i, text in enumerate(texts):
        own = text.split()
        words += own
        counts[i] = len(own)
        seen = set()
        for line in text.split(b"\n"):
            bare = line.strip()
            if bare:
                lines[i] += 1
                repeats[i] += line in seen
                ellipses[i] += bare.endswith(_ELLIPSES)
                bullets[i] += bare.startswith(_BULLETS)
                seen.add(line)
    doc = np.repeat(np.arange(n), counts)

    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)   # one blank after every text
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, n) + 1)
    kind = _KIND[raw]

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(flags, dtype=np.int64)])
        return np.diff(total[np.concatenate([np.zeros(1, np.int64), ends])]) if n else np.zeros(0, np.int64)

    blank = (kind & _BLANK) > 0
    edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)

    def per_word(flag: int) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.int32), np.cumsum((kind & flag) > 0, dtype=np.int32)])
        return total[last] - total[first]

    def of_texts(flags: np.ndarray) -> np.ndarray:
        return np.bincount(doc[flags], minlength=n).astype(np.int64)

    return {
        "n_words": counts,
        "word_chars": per_text(((raw & 0xC0) != 0x80) & ~blank),
        "n_symbols": per_text((kind & _SYMBOL) > 0),
        "n_dup_lines": repeats,
        "n_repeat_words": of_texts(repeated_words(words, doc)),
        "n_lines": lines,
        "n_letterless_words": of_texts(per_word(_LETTER) == 0),
        "n_capital_words": of_texts((per_word(_CAPITAL) >= 2) & (per_word(_LOWER) == 0)),
        "n_exclamations": per_text((kind & _EXCLAMATION) > 0),
        "n_ellipsis_lines": ellipses,
        "n_bullet_lines": bullets,
    }


def failed_bits() -> Column:
    """The rules' failure bits, from the measures."""
    bits = F.lit(0).cast("long")
    for name, rule in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << BITS[name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, ``keep``'s columns, the measures and ``failed``: one row per document, without a shuffle."""
    carried = [id_col, *keep]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)], F.col(f"`{text_col}`").cast("binary").alias("text"))
    schema = StructType([*rows.schema.fields[:-1], *[StructField(m, LongType()) for m in MEASURES]])

    def each(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for part in parts:
            texts = [t or b"" for t in part.column(len(carried)).to_pylist()]
            for lo, hi in batches(texts):
                found = measure(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [part.column(k).slice(lo, hi - lo) for k in range(len(carried))]
                    + [pa.array(found[m], pa.int64()) for m in MEASURES], names=schema.names)

    measured = rows.mapInArrow(each, schema).withColumn("failed", failed_bits())
    return measured.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], *MEASURES, "failed")


# ----------------------------------------------------------------- policies

def fails(p: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(p.mask).cast("long")) != 0


def verdicts(book: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """The ledger with one boolean per policy, ``kept_<name>_v<version>``."""
    return book.select("*", *[(~fails(p)).alias(f"kept_{p.name}_v{p.version}") for p in policies])


def ablations(book: DataFrame, policies: list[Policy] = POLICIES, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per policy and rule (and group of ``by``'s columns): what the rule costs, and what goes without it.

    documents, kept (by the whole policy), failed (by this rule), failed_alone (by no other rule of the policy:
    what leaving the rule out brings back), kept_without = kept + failed_alone, and never_decides: no document
    fails by this rule alone. Documents meet as counts per pattern of bits, combined on the map side, so
    neither a hot group nor the texts are shuffled.
    """
    patterns = book.groupBy(*by, "failed").agg(F.count(F.lit(1)).alias("_n"))
    wanted = F.array(*[F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
                                F.lit(p.mask).cast("long").alias("mask"), F.lit(1 << BITS[r]).cast("long").alias("bit"))
                       for p in policies for r in p.rules])
    each = patterns.withColumn("_w", F.explode(wanted)).select(*by, "failed", "_n", "_w.*")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    counts = each.groupBy(*by, "policy", "version", "rule").agg(
        F.sum("_n").alias("documents"),
        F.sum(F.when(hit == 0, F.col("_n")).otherwise(0)).alias("kept"),
        F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("_n")).otherwise(0)).alias("failed"),
        F.sum(F.when(hit == F.col("bit"), F.col("_n")).otherwise(0)).alias("failed_alone"))
    return (counts.withColumn("kept_without", F.col("kept") + F.col("failed_alone"))
            .withColumn("never_decides", F.col("failed_alone") == 0))


def rule_groups(book: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Per group: the rules that any of its documents fails and those that all of them fail, as bits."""
    return book.groupBy(*by).agg(F.count(F.lit(1)).alias("documents"), F.bit_or("failed").alias("failed_by_any"),
                                 F.bit_and("failed").alias("failed_by_all"))


QUERY_POLICY = policy("prose")


def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = ledger(C.read_documents(spark, sf_dir))
    return book.select("doc_id", *MEASURES[:5], fails(policy("base")).alias("base_failed"), (~fails(QUERY_POLICY)).alias("kept"),
                       *MEASURES[5:], "failed")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LINES = r"list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"
_BARE = r"regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
OP12_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w, {_LINES} AS l FROM documents),
m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines,
    CASE WHEN len(w) < 3 THEN 0 ELSE (
      WITH g AS (SELECT i, (w[i], w[i + 1], w[i + 2]) AS t FROM (SELECT unnest(range(1, len(w) - 1)) AS i)),
      h AS (SELECT i, count(*) OVER (PARTITION BY t) AS n FROM g)
      SELECT count(DISTINCT i + k) FROM h, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1) END AS n_repeat_words,
    len(l) AS n_lines,
    len(list_filter(w, lambda x: regexp_full_match(x, '[\x00-@\[-`{{-\x7f]+'))) AS n_letterless_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z][^a-z]*[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_capital_words,
    length(text) - length(replace(text, '!', '')) AS n_exclamations,
    len(list_filter(l, lambda x: regexp_matches({_BARE}, '(\.\.\.|{chr(0x2026)})$'))) AS n_ellipsis_lines,
    len(list_filter(l, lambda x: regexp_matches({_BARE}, '^[-*{chr(0x2022)}]'))) AS n_bullet_lines
  FROM d),
f AS (SELECT *, {" + ".join(f"CASE WHEN {rule} THEN {1 << BITS[name]} ELSE 0 END" for name, rule in RULES.items())} AS failed FROM m)
SELECT doc_id, {", ".join(f"CAST({m} AS BIGINT) AS {m}" for m in MEASURES)}, CAST(failed AS BIGINT) AS failed,
  failed & {policy("base").mask} <> 0 AS base_failed, failed & {QUERY_POLICY.mask} = 0 AS kept
FROM f
"""
