"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one failure bit per rule; a policy is a named mask over those bits, so a
new policy version or an ablation never touches the texts again.

Defined cases: a null or empty text has no words, all measurements 0, and
fails ``few_words``. Repeated rows give repeated ledger rows. An empty table
gives an empty ledger. Columns other than the two named ones are not read, so
extra columns cannot clash. A long text is one row of work, almost linear in its size; beyond 1 MB its windows
and lines are held as 128-bit digests in arrays, not as objects.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.common import arrow_map, parts, shipped, utf8

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


#: Longest text whose words and lines are held as objects; longer ones are read part by part.
WHOLE_BYTES = 1 << 20
#: The bytes inside a UTF-8 character: all others begin one.
INNER = bytes(range(0x80, 0xC0))


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice, first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = bytearray(len(words))
    for i in compress(range(len(windows)), (counts[w] > 1 for w in windows)):
        covered[i:i + 3] = b"\x01\x01\x01"
    return covered.count(1)


def again(digests: bytearray) -> tuple[np.ndarray, int]:
    """Of 16-byte digests: which occur at least twice, and how many equal an earlier one."""
    d = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    order = np.lexsort((d[:, 1], d[:, 0]))
    ranked = d[order]
    same = (ranked[1:] == ranked[:-1]).all(axis=1)
    hot = np.zeros(len(d), bool)
    hot[order[1:][same]] = True
    hot[order[:-1][same]] = True
    return hot, int(same.sum())


def repeated_words_of(data: bytes) -> tuple[int, int]:
    """Words of a long text, and those that ``repeated_words`` counts, by 128-bit digests of the windows."""
    digests, n, last = bytearray(), 0, []
    for part in parts(data):
        words = part.split()
        n += len(words)
        last += words
        for window in zip(last, last[1:], last[2:]):
            digests += xxhash.xxh3_128_digest(b" ".join(window))
        last = last[-2:]
    if n < 3:
        return n, 0
    hot, _ = again(digests)
    covered = np.zeros(n, bool)
    for j in range(3):
        covered[j:n - 2 + j] |= hot
    return n, int(covered.sum())


def repeated_lines_of(data: bytes) -> tuple[int, int]:
    """Lines of a long text that have a word, and those of them equal to an earlier line."""
    digests, at = bytearray(), 0
    while at <= len(data):
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)]
        if not line.isspace() and line:
            digests += xxhash.xxh3_128_digest(line)
        at = end + 1 if end >= 0 else len(data) + 1
    return len(digests) // 16, again(digests)[1] if digests else 0


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    data = utf8(text)
    chars = len(data.translate(None, SPACE + INNER))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    if len(data) > WHOLE_BYTES:
        n_words, repeated = repeated_words_of(data)
        return (n_words, chars, symbols, *repeated_lines_of(data), repeated)
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), repeated_words(words)


#: name -> failure test, all in integers; a rule's place is its bit. ``m`` gives a measurement.
RULES: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "few_words": lambda m: m("n_words") < 50,
    "repeated_windows": lambda m: 100 * m("n_repeat_words") > 50 * m("n_words"),
    "symbol_heavy": lambda m: 100 * m("n_symbols") > 10 * m("n_words"),
    "repeated_lines": lambda m: 100 * m("n_dup_lines") > 50 * m("n_lines"),
    "short_words": lambda m: m("word_chars") < 2 * m("n_words"),
    "long_words": lambda m: m("word_chars") > 20 * m("n_words"),
    "very_long": lambda m: m("n_words") > 1_000_000,
}
RULE_NAMES = tuple(RULES)

#: Policy version -> rules that reject. "base" holds the two contract rules.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbol_heavy", "repeated_lines",
           "short_words", "long_words"),
}


def mask(policy: str) -> int:
    return sum(1 << RULE_NAMES.index(r) for r in POLICIES[policy])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, measurements and ``fail_bits``."""
    kind = dict(docs.select(id_col).dtypes)[id_col]

    def run(batch: pa.RecordBatch) -> dict:
        rows = [measure_text(t) for t in batch.column(1).to_pylist()]
        cols = zip(*rows)
        return {id_col: batch.column(0)} | {m: pa.array(v, pa.int64()) for m, v in zip(MEASURES, cols)}

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES)
    measured = arrow_map(docs.select(id_col, text_col), run, schema)
    return measured.withColumn("fail_bits", failure_bits())


def failure_bits(m: Callable[[str], Column] = F.col) -> Column:
    """Every rule evaluated once, one bit each."""
    bits = F.lit(0).cast("long")
    for i, test in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(test(m), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits


def passes(policy: str, bits: Column | None = None) -> Column:
    bits = F.col("fail_bits") if bits is None else bits
    return bits.bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(ledger_df: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents failing it, failing only it, and kept without it.

    The ledger first collapses to one count per distinct bit pattern (at most
    2 to the number of rules), so the rest runs on a table of bounded size.
    """
    m = mask(policy)
    names = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << RULE_NAMES.index(n)).cast("long").alias("bit"))
                      for n in POLICIES[policy]])
    patterns = (ledger_df.select(F.col("fail_bits").bitwiseAND(F.lit(m).cast("long")).alias("bits"))
                .groupBy("bits").agg(F.count(F.lit(1)).alias("n")))
    each = patterns.select("bits", "n", F.explode(names).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(hit & rest, F.col("n")).otherwise(0)).alias("failed_only_this"),
        F.sum(F.when(rest, F.col("n")).otherwise(0)).alias("kept_without"))


def filter_documents(docs: DataFrame, policy: str, text_col: str = "text") -> DataFrame:
    """Documents that pass a policy, with their own columns, in one narrow pass.

    The measurements travel as one struct under a name that no input column has.
    """
    name = "ledger"
    while name in docs.columns:
        name += "_"

    @F.pandas_udf(", ".join(f"{m} bigint" for m in MEASURES))
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure_text(t) for t in texts], columns=list(MEASURES), dtype="int64")

    packed = shipped(docs).withColumn(name, measured(F.col(text_col)))
    bits = failure_bits(lambda m: F.col(name)[m])
    return packed.filter(passes(policy, bits)).drop(name)
