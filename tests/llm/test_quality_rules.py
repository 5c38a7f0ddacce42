"""Statistics against brute force, and what the learned list decides."""

import re

from adledger.llm import quality_rules as q
from adledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["", None, " \n\t ", "one", "a b", "a b c", "a b c a b c", "x\n x\nx\n\ny\n \n\ny|é # é", "a a a a a a", "\x0b\x0c# & é\r\n# & é", "z " * 30_000, "p q r s\n" * 5]


def brute(text):
    text = text or ""
    words, found, seen, dup = WORD.findall(text), {}, set(), 0
    for i in range(len(words) - 2):
        found.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {k for at in found.values() if len(at) > 1 for i in at for k in (i, i + 1, i + 2)}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def test_statistics_of_odd_texts(docs_of):
    rows = q.judged(docs_of(list(enumerate(TEXTS))), []).collect()
    got = {r.doc_id: r._quality for r in rows}
    for i, t in enumerate(TEXTS):
        s = got[i]
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words, s.base_failed) == brute(t), t
        assert s.kept == (not s.base_failed)


def test_no_labels_no_rules(spark, docs_of):
    docs = docs_of([(1, "a b")])
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 0)], "doc_id long, quality int")
    assert q.learn_rules(docs, labels) == []
    assert q.learn_rules(docs, labels.filter("doc_id > 5")) == []
    assert q.judged(docs.filter("doc_id > 5"), []).count() == 0


def test_learned_rules_find_junk_and_spare_clean_texts(spark, docs_of):
    clean = [(i, " ".join(f"w{(i * 7 + k) % 301}x{k}" for k in range(80))) for i in range(300)]
    junk = [(1000 + i, " | ".join(f"v{(i * 5 + k) % 211}y{k}" for k in range(80))) for i in range(60)]
    docs = docs_of(clean + junk)
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in clean[::2] + junk[::2]], "doc_id long, quality int")
    rules = q.learn_rules(docs, labels)
    assert rules and all(1 <= len(r) <= 4 for r in rules)
    kept = {r.doc_id: r._quality.kept for r in q.judged(docs, rules).collect()}
    assert all(kept[i] == (i < 1000) for i in kept)


def test_rules_are_one_conditional_expression(docs_of):
    rules = [(q.Literal("word_length", True, 4.0), q.Literal("digit_share", True, 0.5)), (q.Literal("symbol_share", True, 0.1),)]
    long = " ".join(["12345"] * 2 + [f"{k}5678" for k in range(60)])
    rows = q.judged(docs_of([(1, long), (2, " ".join(f"w{k}" for k in range(60)))]), rules).collect()
    assert {r.doc_id: r._quality.kept for r in rows} == {1: False, 2: True}
    assert [str(x) for x in rules[0]] == ["word_length > 4", "digit_share > 0.5"]


def test_op5_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op5_quality_rules"](spark, SF)
    assert "Python" not in rows._jdf.queryExecution().toString()
    for r in rows.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(docs[r.doc_id])
        assert not (r.base_failed and r.kept)
