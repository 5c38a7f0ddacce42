"""Quality classifier: hierarchical empirical Bayes over documents, paths and hosts.

A logistic classifier over the shape of a text gives each document its evidence: how much likelier the text is among good
documents than among bad ones. Hosts and the paths below them get posterior shares of good documents: labels where there
are any, else the classifier's expectation, summed by grouped aggregation and shrunk, a path towards its host and a host
towards the whole corpus. How strongly is estimated from the data: the less groups differ beyond chance, the more of a
small group's share comes from above. A document's posterior is its evidence on top of its path's share, taken without
the document itself, so nothing counts twice.

Defined cases: a null text is empty. Null hosts and paths are groups of their own. An id with two different labels has
none, and null labels are none. Without labels of both kinds there is no evidence, and every document has the prior.
Repeated rows are judged alike. An empty table gives no rows. Other columns of the table are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger.llm.rows import bodies, slices, whole_text
from adledger.session import saved

#: Bytes that features count: punctuation one by one, and these classes.
MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
CLASSES = [list(range(65, 91)), list(range(97, 123)), list(range(48, 58)), [32], [10], list(range(128, 256))]
N_FEATURES = len(MARKS) + len(CLASSES) + 5


def features(body: bytes) -> np.ndarray:
    """Square roots of byte shares, and how long words are and how much of the text repeats."""
    counts = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    shares = np.array([*counts[MARKS], *(counts[c].sum() for c in CLASSES)]) / max(len(body), 1)
    words, lines = body.split(), body.split(b"\n")
    n = max(len(words), 1)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    more = [math.log1p(len(words)) / 10, len(body) / n / 20, len(set(words)) / n, again / n, len(set(lines)) / len(lines)]
    return np.concatenate([np.sqrt(shares), more]).astype(np.float32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [features(b) for b in batch.column("body").to_pylist()]
        at = batch.schema.get_field_index("body")
        columns = [batch.column(k) for k in range(batch.num_columns) if k != at]
        flat = pa.array(np.concatenate(rows)) if rows else pa.array([], pa.float32())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * N_FEATURES), flat)
        yield pa.RecordBatch.from_arrays([*columns, lists], names=[*(n for n in batch.schema.names if n != "body"), "x"])


@dataclass(frozen=True)
class Model:
    weights: list[float]
    intercept: float
    prior: float

    def evidence(self, x: Column) -> Column:
        """Log of how much likelier the text is among good documents than among bad ones."""
        score = sum((F.get(x, k) * float(w) for k, w in enumerate(self.weights) if w), F.lit(self.intercept))
        return (score - math.log(self.prior / (1 - self.prior))).cast("double")


def labels_of(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    told = labels.filter(labels[label_col].isNotNull() & labels[id_col].isNotNull()).groupBy(labels[id_col].cast("long").alias("l_id"))
    return told.agg(F.min(label_col).alias("least"), F.max(label_col).alias("most")).filter("least = most").select("l_id", (F.col("least") > 0).cast("double").alias("good"))


def train(rows: DataFrame, sample_rows: int = 20_000, penalty: float = 1e-3) -> Model:
    """A logistic classifier from at most ``sample_rows`` labelled rows (x, good), those whose id has the least hash."""
    sample = rows.filter("good IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = saved(sample.select("good", array_to_vector(F.col("x").cast("array<double>")).alias("x")), "classifier-sample")
    n, good = sample.agg(F.count("*"), F.sum("good")).first()
    if not n or good in (0, n):
        return Model([], 0.0, 0.5) if not n else Model([], math.log((good + 0.5) / (n - good + 0.5)), (good + 0.5) / (n + 1))
    fitted = LogisticRegression(featuresCol="x", labelCol="good", regParam=penalty, maxIter=60).fit(sample)
    return Model(fitted.coefficients.toArray().tolist(), float(fitted.intercept), good / n)


def strength(groups: DataFrame, mean: float) -> float:
    """How many documents the level above is worth to a group: the method of moments for shares of groups (n, s).

    What groups differ by beyond chance is the variance between them; the less of it, the stronger the shrinking.
    """
    g, total, squares, spread = groups.agg(F.count("*"), F.sum("n"), F.sum(F.col("n") * F.col("n")), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - mean, 2))).first()
    if not g or g < 2 or not 0 < mean < 1:
        return 1e6
    between = (spread - (g - 1) * mean * (1 - mean)) / max(total - squares / total, 1e-9)
    return min(max(mean * (1 - mean) / between - 1, 1.0), 1e6) if between > 0 else 1e6


def site_levels(url: Column) -> tuple[Column, Column]:
    """Host and first path segment of a web address."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return host, F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+/([^/?#]*)", 1)


def classify(
    docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", least: float = 0.5, sample_rows: int = 20_000,
) -> DataFrame:
    """A row per row of ``docs``: doc_id, host, path, evidence, host_share, path_share, posterior and kept.

    ``path_col`` is the level below the host. Group sums are combined in the tasks before they are shuffled, and documents
    meet their path's share in a join of narrow rows.
    """
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[host_col].cast("string").alias("host"), docs[path_col].cast("string").alias("path"), whole_text(docs, text_col).cast("binary").alias("body"))
    shaped = source.mapInArrow(_features, "doc_id long, host string, path string, x array<float>")
    shaped = saved(shaped, "document-features")
    told = saved(labels_of(labels, id_col, label_col), "known-labels")
    rows = shaped.join(told, shaped["doc_id"] == told["l_id"], "left").drop("l_id")
    model = train(rows, sample_rows)
    odds = math.log(model.prior / (1 - model.prior))
    chance = lambda x: 1 / (1 + F.exp(-x))
    scored = rows.withColumn("evidence", model.evidence(F.col("x"))).withColumn("p", F.coalesce("good", chance(F.col("evidence") + odds)))
    scored = saved(scored.select("doc_id", "host", "path", "evidence", "p"), "document-evidence")
    paths = saved(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "path-sums")
    total, whole = paths.agg(F.sum("n"), F.sum("s")).first()
    mean = min(max((whole or 0.0) / total, 1e-6), 1 - 1e-6) if total else model.prior
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    upper = strength(hosts, mean)
    hosts = saved(hosts.select(F.col("host").alias("h_host"), ((F.col("s") + upper * mean) / (F.col("n") + upper)).alias("host_share")), "host-shares")
    lower = strength(paths, mean)
    shares = paths.join(hosts, F.col("host").eqNullSafe(F.col("h_host"))).select(F.col("host").alias("h_host"), F.col("path").alias("h_path"), "n", "s", "host_share")
    shares = saved(shares, "path-shares")
    same = F.col("host").eqNullSafe(F.col("h_host")) & F.col("path").eqNullSafe(F.col("h_path"))
    share = F.least(F.greatest((F.col("s") - F.col("p") + lower * F.col("host_share")) / (F.col("n") - 1 + lower), F.lit(1e-6)), F.lit(1 - 1e-6))
    out = scored.join(shares, same).withColumn("path_share", share)
    posterior = chance(F.col("evidence") + F.log(F.col("path_share") / (1 - F.col("path_share"))))
    return out.withColumn("posterior", posterior).select("doc_id", "host", "path", "evidence", "host_share", "path_share", "posterior", (F.col("posterior") >= least).alias("kept"))
