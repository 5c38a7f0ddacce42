"""Byte-level BPE: encoding by tree concatenation, and decoding.

A text of up to ``leaf_chars`` characters is encoded at once. A longer one is halved until its parts are as short; the
parts are rows of their own, encoded in parallel on any executor. Then neighbours are joined, pair by pair up the tree.
At a join, a window of text around the cut is split and encoded anew, and grows until both sides agree with it exactly:

* Splitting is a scan without memory, so once the window's scan stops where the right part's scan stopped, both go on
  alike. On the left it starts at a place that the cut is too far from to matter.
* Inside one unbroken stretch, a sequence of tokens is the encoding of its bytes exactly if each two neighbours are the
  encoding of theirs. So a window of tokens that begins with the left part's token and ends with the right part's fits.

The engine merges adjacent pieces whenever their concatenation is a token. That is the same as following the merge list
as long as every token's own bytes encode to just that token and ids rise with the merges; ``Vocabulary`` checks both.

Defined cases: a null text is empty and has no tokens. Special tokens in a text become their ids. Repeated rows and null
ids are encoded like all others; an empty table gives no rows. Other columns of the table are not looked at.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adledger.llm.rows import slices, whole_text

#: Fixed value: the pattern by which byte-level vocabularies of this kind split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that the pattern looks at beyond the end of a match, at most.
LOOKAHEAD = 3
#: Bytes above which a stretch is joined from its parts' tokens and not encoded again.
LONG = 512


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where Latin-1 prints it, else the next free character from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary from the contents of its JSON file."""

    def __init__(self, contents: bytes, checked: bool = False) -> None:
        spec, alphabet = json.loads(contents), byte_alphabet()
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab = {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.engine = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens=self.special)
        self.contents = contents
        self.sizes = np.zeros(max([*vocab.values(), *self.special.values()]) + 1, np.int64)
        for t, i in vocab.items():
            self.sizes[i] = len(t)
        for t, i in self.special.items():
            self.sizes[i] = len(t.encode())
        # A cut further away than this changes neither a match nor whether a special token follows it.
        self.margin = LOOKAHEAD + max((len(t.encode()) for t in self.special), default=0)
        if not checked:
            self._check(spec, vocab, alphabet)

    def _check(self, spec: dict, vocab: dict[bytes, int], alphabet: dict[str, int]) -> None:
        if spec.get("normalizer") or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError("only byte-level vocabularies without a normalizer and prefix space are supported")
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not supported")
        names = list(self.special)
        if any(a.startswith(b[k:]) for a in names for b in names for k in range(len(b)) if (a, 0) != (b, k)):
            raise ValueError("special tokens that can overlap are not supported")
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        merged = [vocab[bytes(alphabet[c] for c in a + b)] for a, b in pairs]
        if merged != sorted(set(merged)) or len(vocab) != len(merged) + 256 or merged[0] < 256:
            raise ValueError("token ids do not rise with the merges")
        model = Tokenizer.from_str(json.dumps({**spec, "pre_tokenizer": None, "decoder": None, "added_tokens": []}))
        tokens = list(spec["model"]["vocab"])
        wanted = [[spec["model"]["vocab"][t]] for t in tokens if t not in self.special]
        got = [e.ids for e in model.encode_batch_fast([t for t in tokens if t not in self.special], add_special_tokens=False)]
        if got != wanted:
            raise ValueError("some tokens are not the encoding of their own bytes")

    @cached_property
    def splitter(self):
        return Tokenizer.from_str(self.contents.decode()).pre_tokenizer

    def encode(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.engine.encode(text, allowed_special="all")
        return self.engine.encode_ordinary(text)

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the decoded text; bytes that are none become replacement characters."""
        body = self.engine.decode_bytes(ids)
        return body.decode("utf-8", "replace").encode()

    def stretch(self, body: bytes) -> list[int]:
        """The encoding of bytes that splitting leaves whole."""
        return self.engine._encode_single_piece(body) if body else []

    def splits(self, text: str) -> np.ndarray:
        """Byte lengths of the stretches of a text, special tokens being stretches too."""
        lengths: list[int] = []
        while text:
            at, name = min(((k, s) for s in self.special if (k := text.find(s)) >= 0), default=(len(text), ""))
            if at:
                lengths.extend(len(t) for t, _ in self.splitter.pre_tokenize_str(text[:at]))
            if name:
                lengths.append(len(name.encode()))
            text = text[at + len(name):]
        return np.array(lengths, np.int64)


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


class Part:
    """A stretch of text with its encoding: bytes, where the splitting cuts it, and tokens."""

    def __init__(self, body: bytes, cuts: np.ndarray, ids: np.ndarray) -> None:
        self.body, self.cuts, self.ids = body, cuts, ids

    @classmethod
    def of(cls, text: str, v: Vocabulary) -> Part:
        return cls(text.encode(), _starts(v.splits(text)), np.array(v.encode(text), np.uint32))

    def between(self, lo: int, hi: int, starts: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(starts, lo):np.searchsorted(starts, hi)]


def join_stretch(left: np.ndarray, right: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The encoding of two encoded byte strings put together, as one stretch."""
    k = 4
    while True:
        a, b = left[-k:], right[:k]
        window = v.stretch(v.engine.decode_bytes(a.tolist()) + v.engine.decode_bytes(b.tolist()))
        if (k >= len(left) or window[0] == a[0]) and (k >= len(right) or window[-1] == b[-1]):
            return np.concatenate([left[:len(left) - len(a)], np.array(window, np.uint32), right[len(b):]])
        k *= 2


def join(a: Part, b: Part, v: Vocabulary) -> Part:
    """The encoding of two encoded parts put together."""
    if not a.body or not b.body:
        return b if not a.body else a
    n, body = len(a.body), a.body + b.body
    lo = int(a.cuts[max(0, np.searchsorted(a.cuts, n - v.margin, "right") - 1)])
    reach, own = 64, b.cuts + n
    while True:
        k = min(np.searchsorted(own, n + reach), len(own) - 1)
        hi = int(own[k])
        cuts = _starts(v.splits(body[lo:hi].decode())) + lo
        settled = cuts if hi == len(body) else cuts[cuts <= hi - v.margin]
        agreed = settled[(settled >= n) & np.isin(settled, own)]
        if len(agreed):
            break
        reach *= 4
    end = int(agreed[0])
    cuts = cuts[cuts <= end]
    a_at, b_at = _starts(v.sizes[a.ids]), _starts(v.sizes[b.ids]) + n
    a_cuts, tokens = set(a.cuts[a.cuts >= lo].tolist()), [a.between(0, lo, a_at)]
    for s, t in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if t <= n and s in a_cuts and t in a_cuts and a.cuts[np.searchsorted(a.cuts, s) + 1] == t:
            tokens.append(a.between(s, t, a_at))
        elif t - s <= LONG or body[s:t].decode() in v.special:
            tokens.append(np.array(v.encode(body[s:t].decode()) if body[s:t].decode() in v.special else v.stretch(body[s:t]), np.uint32))
        else:
            tokens.append(_from_parts(s, t, a, b, body, a_at, b_at, v))
    ids = np.concatenate([*tokens, b.between(end, len(body), b_at)])
    return Part(body, np.concatenate([a.cuts[a.cuts < lo], cuts, own[own > end]]), ids)


def _from_parts(s: int, t: int, a: Part, b: Part, body: bytes, a_at: np.ndarray, b_at: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The tokens of the stretch from s to t, joined from what both parts have for the pieces they cut it into."""
    n = len(a.body)
    old = np.unique(np.concatenate([[s, t], a.cuts[(a.cuts > s) & (a.cuts < t)], (b.cuts + n)[(b.cuts + n > s) & (b.cuts + n < t)]]))
    ends = np.concatenate([a.cuts, b.cuts + n])
    ids = np.array([], np.uint32)
    for x, y in zip(old[:-1].tolist(), old[1:].tolist(), strict=True):
        whole = x in ends and y in ends
        piece = (a.between(x, y, a_at) if y <= n else b.between(x, y, b_at)) if whole else np.array(v.stretch(body[x:y]), np.uint32)
        ids = join_stretch(ids, piece, v) if len(ids) else piece
    return ids


def halves(text: str, leaf_chars: int) -> list[str]:
    """The text halved until no part is longer than ``leaf_chars``."""
    if len(text) <= leaf_chars:
        return [text]
    mid = len(text) // 2
    return halves(text[:mid], leaf_chars) + halves(text[mid:], leaf_chars)


def join_tree(parts: list[Part], v: Vocabulary) -> Part:
    while len(parts) > 1:
        parts = [join(*parts[k:k + 2], v) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


#: The vocabulary of a task, which calls some functions many times.
LOADED: dict[bytes, Vocabulary] = {}


def _loaded(contents) -> Vocabulary:
    if contents.value not in LOADED:
        LOADED[contents.value] = Vocabulary(contents.value, checked=True)
    return LOADED[contents.value]


def _refusal(batches: Iterator[pa.RecordBatch], contents) -> Iterator[pa.RecordBatch]:
    """The error of a vocabulary that the method does not fit; no row if it does."""
    for _ in batches:
        try:
            Vocabulary(contents.value)
        except Exception as e:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(e)], pa.binary())], names=["error"])


def _little(ids: np.ndarray | list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def _encode_short(batches: Iterator[pa.RecordBatch], contents) -> Iterator[pa.RecordBatch]:
    v = _loaded(contents)
    for batch in slices(batches):
        ids = [v.encode(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([_little(x) for x in ids], pa.binary())], names=["doc_id", "n_tokens", "ids"])


def _cut(batches: Iterator[pa.RecordBatch], leaf_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        row = batch.to_pylist()[0]
        leaves = halves(row["text"], leaf_chars)
        for at in range(0, len(leaves), 64):
            part = leaves[at:at + 64]
            yield pa.RecordBatch.from_pydict({"row_id": [row["row_id"]] * len(part), "doc_id": pa.array([row["doc_id"]] * len(part), pa.int64()), "leaf": list(range(at, at + len(part))), "text": part})


def _encode_leaves(batches: Iterator[pa.RecordBatch], contents) -> Iterator[pa.RecordBatch]:
    v = _loaded(contents)
    for batch in slices(batches, 16):
        parts = [Part.of(t, v) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), batch.column("doc_id"), batch.column("leaf"), pa.array([p.body for p in parts], pa.binary()), pa.array([p.cuts.tobytes() for p in parts], pa.binary()), pa.array([_little(p.ids) for p in parts], pa.binary())],
            names=["row_id", "doc_id", "leaf", "body", "cuts", "ids"],
        )


def _join_leaves(table: pa.Table, contents) -> pa.Table:
    v = _loaded(contents)
    rows = table.sort_by("leaf")
    parts = [Part(x["body"], np.frombuffer(x["cuts"], np.int64), np.frombuffer(x["ids"], "<u4")) for x in rows.select(["body", "cuts", "ids"]).to_pylist()]
    ids = join_tree(parts, v).ids
    return pa.table({"doc_id": rows.column("doc_id")[:1], "n_tokens": pa.array([len(ids)], pa.int64()), "ids": pa.array([_little(ids)], pa.binary())})


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", leaf_chars: int = 1 << 15) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (unsigned 32-bit little-endian) of every row.

    ``vocabulary`` is the path of the vocabulary's JSON file on the driver; its contents (a few MB) go to the tasks. It is
    checked in a task too: taken apart, it needs about 100 MB, and the driver would keep most of that after each call.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    for r in spark.range(0, 1, numPartitions=1).mapInArrow(partial(_refusal, contents=sent), "error binary").collect():
        raise pickle.loads(r["error"])
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), whole_text(docs, text_col).alias("text"))
    out = "doc_id long, n_tokens long, ids binary"
    short = rows.filter(F.length("text") <= leaf_chars).mapInArrow(partial(_encode_short, contents=sent), out)
    leaves = (
        rows.filter(F.length("text") > leaf_chars).withColumn("row_id", F.monotonically_increasing_id())
        .mapInArrow(partial(_cut, leaf_chars=leaf_chars), "row_id long, doc_id long, leaf long, text string")
        .repartition("row_id", "leaf")
        .mapInArrow(partial(_encode_leaves, contents=sent), "row_id long, doc_id long, leaf long, body binary, cuts binary, ids binary")
    )
    return short.unionByName(leaves.groupBy("row_id").applyInArrow(lambda table: _join_leaves(table, sent), out))


def _decode(batches: Iterator[pa.RecordBatch], contents) -> Iterator[pa.RecordBatch]:
    v = _loaded(contents)
    for batch in slices(batches):
        texts = [v.decode(np.frombuffer(x, "<u4").tolist()) for x in batch.column("ids").to_pylist()]
        at = batch.schema.get_field_index("ids")
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(batch.num_columns)), pa.array(texts, pa.binary()).cast(pa.string())], names=[*batch.schema.names, "decoded"]) if at >= 0 else batch


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Rows of ``encode`` with ``decoded``, the text of ``ids``; special tokens are written out."""
    with open(vocabulary, "rb") as f:
        sent = encoded.sparkSession.sparkContext.broadcast(f.read())
    return encoded.mapInArrow(partial(_decode, contents=sent), "doc_id long, n_tokens long, ids binary, decoded string")
