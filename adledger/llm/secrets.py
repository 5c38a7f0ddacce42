"""Secret scans: fixed patterns, and a randomness test battery with length-aware false-discovery control.

Patterns find assignments, access keys and long hex runs. Beside them, every long run of key characters is a candidate.
Its encoding is inferred from the characters it uses, and its symbols, as numbers in that alphabet, are tested three ways:
chi-squared uniformity, runs about the middle, and lag-one serial correlation. Two questions are asked of a candidate:

* Could a random key look like this? The three p-values, combined by Fisher's method, must not reject it.
* Could ordinary text look like this? The chi-squared statistic counts equal pairs of symbols. Text, with the symbol
  frequencies of the whole corpus, has more of them; the p-value is the chance of so few.

The second p-values are judged by the Benjamini-Hochberg rule over the whole corpus, apart for each encoding and class of
lengths: short runs carry little evidence, and their many tests do not thin out what long ones show. Only a histogram of
p-values is gathered, of a size that does not depend on the corpus.

Defined cases: a null text is empty; an empty text has no spans. Repeated rows and null ids are scanned like all others.
An empty table gives no rows. Other columns of the table are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adledger.llm.rows import bodies, slices
from adledger.session import saved

#: The patterns and least lengths of the base.
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "random")

#: Alphabets, narrowest first; a candidate gets the first that has all its characters.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "hex-upper": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base36-upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
#: P-values are kept as steps of a twentieth of a power of ten, rounded up, down to 10**-15.
STEPS, LAST_STEP = 20, 300


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base's spans, in order."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def encoding_of(run: str) -> str | None:
    """The narrowest alphabet of a run that has digits; letters alone are no encoding."""
    used = set(run)
    if not used & set("0123456789"):
        return None
    return next((n for n, a in ALPHABETS.items() if used <= set(a)), None)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_tail(x: float, k: int) -> float:
    """Upper tail of chi-squared with k degrees of freedom, by the cube-root normal approximation."""
    z = ((max(x, 0.0) / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(symbols: np.ndarray, k: int) -> tuple[float, float, float]:
    """P-values, under randomness, of uniformity, runs and serial correlation."""
    n = len(symbols)
    counts = np.bincount(symbols, minlength=k).astype(float)
    uniform = _chi_tail(float(((counts - n / k) ** 2).sum() * k / n), k - 1)
    above = 2 * symbols >= k
    a, b = int(above.sum()), int(n - above.sum())
    runs = 0.0
    if a and b:
        mean = 2 * a * b / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs = _two_sided((1 + int((above[1:] != above[:-1]).sum()) - mean) / math.sqrt(var)) if var > 0 else 1.0
    d = symbols - symbols.mean()
    serial = _two_sided((float((d[1:] * d[:-1]).sum() / (d * d).sum()) + 1 / n) * math.sqrt(n)) if d.any() else 0.0
    return uniform, runs, serial


def fisher(ps: tuple[float, ...]) -> float:
    """Fisher's combination: the upper tail of chi-squared with twice as many degrees of freedom."""
    half = -sum(math.log(max(p, 1e-300)) for p in ps)
    return math.exp(-half) * sum(half**i / math.factorial(i) for i in range(len(ps)))


def text_p(symbols: np.ndarray, frequencies: np.ndarray) -> float:
    """Chance of so few equal pairs of symbols, if they are drawn with the corpus's frequencies."""
    n = len(symbols)
    counts = np.bincount(symbols, minlength=len(frequencies)).astype(float)
    pairs = float((counts * (counts - 1) / 2).sum())
    s2, s3 = float((frequencies**2).sum()), float((frequencies**3).sum())
    mean = n * (n - 1) / 2 * s2
    var = n * (n - 1) / 2 * (s2 - s2**2) + n * (n - 1) * (n - 2) * (s3 - s2**2)
    return 0.5 * math.erfc(-(pairs + 0.5 - mean) / math.sqrt(2 * var)) if var > 0 else 1.0


def length_class(n: int) -> int:
    """Classes of lengths, two to a doubling; beyond 2**12 all are one."""
    return min(24, int(2 * math.log2(n)))


def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(256, np.int64)
    for batch in slices(batches):
        for body in batch.column(0):
            counts += np.bincount(np.frombuffer(body.as_buffer(), np.uint8), minlength=256)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(counts)], names=["byte", "n"])


def symbol_frequencies(texts: DataFrame) -> dict[str, np.ndarray]:
    """How often the corpus has each symbol of each alphabet; every task sends 256 counts. One is added to each count."""
    rows = texts.select("body").mapInArrow(_byte_counts, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    n = {r["byte"]: r["n"] for r in rows}
    counts = {name: np.array([n.get(ord(c), 0) + 1.0 for c in a]) for name, a in ALPHABETS.items()}
    return {name: c / c.sum() for name, c in counts.items()}


def _scan(batches: Iterator[pa.RecordBatch], frequencies: dict[str, np.ndarray], least_run: int, least_random: float) -> Iterator[pa.RecordBatch]:
    candidate = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % least_run)
    index = {name: {c: i for i, c in enumerate(a)} for name, a in ALPHABETS.items()}
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    tested = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.string()), ("length_class", pa.int32()), ("step", pa.int32())]))
    for batch in slices(batches):
        base, more = [], []
        for body in batch.column(1).to_pylist():
            text = body.decode("utf-8", "replace")
            spans, runs, at = base_spans(text), [], 0
            for m in candidate.finditer(text):
                start, end = m.span()
                while at < len(spans) and spans[at][2] <= start:
                    at += 1
                name = encoding_of(m[0])
                if name is None or any(s < end and e > start for s, _, e in spans[max(0, at - 2):at + 64]):
                    continue
                symbols = np.array([index[name][c] for c in m[0]])
                if fisher(battery(symbols, len(ALPHABETS[name]))) >= least_random:
                    p = text_p(symbols, frequencies[name])
                    runs.append({"start": start, "end": end, "encoding": name, "length_class": length_class(end - start), "step": min(LAST_STEP, int(-math.log10(max(p, 1e-300)) * STEPS))})
                else:
                    runs.append({"start": start, "end": end, "encoding": name, "length_class": length_class(end - start), "step": 0})
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
            more.append(runs)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), pa.array(more, tested)], names=["doc_id", "base", "tested"])


def thresholds(tested: DataFrame, false_discoveries: float) -> DataFrame:
    """The least step that is a discovery, by encoding and length class: Benjamini-Hochberg on a histogram.

    A step stands for the largest p-value it can hold, so rounding never adds a discovery.
    """
    cells = tested.groupBy("encoding", "length_class", "step").agg(F.count("*").alias("n"))
    own = W.partitionBy("encoding", "length_class")
    cells = cells.withColumn("rank", F.sum("n").over(own.orderBy(F.desc("step")))).withColumn("all", F.sum("n").over(own))
    p = F.pow(F.lit(10.0), -F.col("step") / STEPS)
    return cells.filter((F.col("step") > 0) & (p <= F.col("rank") / F.col("all") * false_discoveries)).groupBy("encoding", "length_class").agg(F.min("step").alias("least"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_run: int = 20, least_random: float = 0.001, false_discoveries: float = 0.01) -> DataFrame:
    """``doc_id`` and ``spans`` (start, kind, end in code points, end exclusive; kind numbers as in KINDS) of every row."""
    texts = bodies(docs, id_col, text_col)
    run = partial(_scan, frequencies=symbol_frequencies(texts), least_run=least_run, least_random=least_random)
    found = saved(texts.mapInArrow(run, "doc_id long, base array<struct<start:int,kind:int,end:int>>, tested array<struct<start:int,end:int,encoding:string,length_class:int,step:int>>"), "secret-candidates")
    least = thresholds(found.select(F.inline("tested")), false_discoveries).collect()
    passed = F.lit(False)
    kept = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if least:
        table = F.create_map(*(F.lit(x) for r in least for x in (f"{r['encoding']}/{r['length_class']}", r["least"])))
        passed = lambda t: F.coalesce(t["step"] >= table[F.concat_ws("/", t["encoding"], t["length_class"].cast("string"))], F.lit(False))
        kept = F.transform(F.filter("tested", passed), lambda t: F.struct(t["start"], F.lit(3).alias("kind"), t["end"]))
    return found.select("doc_id", F.sort_array(F.concat("base", kept)).alias("spans"))


def joined(spans, kinds: tuple[int, ...]):
    """``kind:start:end`` of the spans of some kinds, comma-joined."""
    wanted = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(wanted, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")
