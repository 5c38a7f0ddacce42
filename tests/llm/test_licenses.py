"""Phrases against brute force; automata on texts with and without optional and replaceable regions."""

import re

import pytest

from adledger.llm import licenses as li
from adledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k:k + len(p)] == p]
    starts = [k for k, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), sorted({x for _, x in places})


def labels(text):
    words = li.words_of(text.encode())
    return {(x, s, e) for x, s, e in li.Matcher(li.TEMPLATES).matches(words, li.framed(words))}


MIT = re.sub(r"<<var[^>]*>>", "Ann Author or her heirs", re.sub(r"<<beginOptional>>.*?<<endOptional>>", "", li.TEMPLATES["mit"], flags=re.S))
TEXTS = [None, "", "CC-BY cc by  CC  BY", "cc by cc by", "all rights reserved " * 3, "GNU General\nPublic License!", "é general public licenseé", "All rights-reserved\x7fall_rights_reserved", "x " * 50_000 + "cc/by", "ccby cc b y"]


def test_phrases_of_odd_texts(docs_of):
    rows = li.scan(docs_of([*enumerate(TEXTS), (3, "cc by cc by"), (None, "cc by")])).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base) == brute("cc by" if r.doc_id is None else TEXTS[r.doc_id])
        assert 0 <= r.score <= 1 and (r.n_base == 0 or r.score > 0)
    assert li.scan(docs_of([(1, "x")]).filter("doc_id > 1")).count() == 0


def test_whole_licenses():
    n = len(li.words_of(MIT.encode()))
    assert labels("before it " + MIT + " after it") == {("mit", 2, n + 2)}
    assert labels(MIT.replace("without restriction", "with restriction")) == set()
    assert labels(MIT.replace("permission notice", "permission notice (including the next paragraph)")) == {("mit", 0, n + 4)}
    assert labels(MIT.replace("Ann Author or her heirs", "x " * 40)) == set()


def test_notices():
    assert {x for x, _, _ in labels("Licensed under CC BY-NC 4.0.")} == {"cc-by-family"}
    assert {x for x, _, _ in labels("This work is licensed under the GNU General Public License, version 3.")} == {"gpl-notice"}
    assert labels("Released under the MIT License. Released under the MIT license.") == {("mit-notice", 0, 5), ("mit-notice", 5, 10)}
    assert labels("This is licensed under CC BY 9.0") == set() == labels("This work is not covered by the MIT License")


def test_markup_compiles_to_automata():
    a = li.Automaton.compiled("a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> <<var;match=[0-9]+;words=0-2>> d")
    for text, end in (("a d", 2), ("a b d", 3), ("a b c d", 4), ("a c d", -1), ("a 1 22 d", 4), ("a b 1 d", 4), ("a 1 2 3 d", -1), ("a x d", -1), ("b d", -1), ("a d d", 2)):
        assert a.longest(text.encode().split(), 0) == end, text
    with pytest.raises(ValueError):
        li.Automaton.compiled("a <<beginOptional>> b")
    with pytest.raises(ValueError):
        li.Automaton.compiled("<<var;match=x>>")


def test_op7_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op7_license_scan"](spark, SF).collect():
        n, k, first, last, base = brute(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, k, first, last, ",".join(base))
        assert set(base) <= set(r.labels.split(",")) or not base


def test_heads_of_any_length():
    words = " ".join(f"w{k}" for k in range(300))
    for head, most in ((words, 300), ("permission is here", 3), ("<<var;match=.+;words=0-90>>", 90), ("a <<beginOptional>>b permission<<endOptional>> c", 4)):
        a = li.Automaton.compiled(f"<<beginOptional>>{head}<<endOptional>> permission granted")
        assert a.runs == [[b"permission", b"granted"]] and a.reach() == most
    assert li.Automaton.compiled("permission granted").reach() == 0
