import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from documents_llm import no_documents, odd_documents, prose  # noqa: F401

from tickloom.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def distance_is_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def brute(docs):
    """The contract, in plain Python: (word, form, root, n, n_near, form_n)."""
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if distance_is_one(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return rows


def corpus(seed, n):
    r = random.Random(seed)
    roots = ["conténtment", "letterhead", "Überlegung", "marshalling", "aaaaaaaa", "abababab", "straßenbahn", "réglementé", "mountain"]
    docs = []
    for i in range(n):
        ws = []
        for _ in range(40):
            w = r.choice(roots)
            for _ in range(r.choice([0] * 12 + [1, 1, 1, 2])):
                at, c = r.randrange(len(w)), r.choice("abeéstß÷z")
                w = r.choice([w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]])
            ws.append(w if r.random() < 0.8 else w.upper())
        docs.append((i, r.choice([" ", ", ", "-", "\n"]).join(ws)))
    return docs


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


@pytest.mark.parametrize("crowded", [200, 3, 0])
def test_against_all_pairs(spark, monkeypatch, crowded):
    """With roomy buckets, with some crowded ones, and with nothing but crowded ones."""
    monkeypatch.setattr(spelling, "CROWDED", crowded)
    monkeypatch.setattr(spelling, "_LONG", 8)
    docs = corpus(crowded, 150)
    got = {tuple(row) for row in spelling.variants(frame(spark, docs)).collect()}
    want = brute(docs)
    assert got == want
    assert any(row[1] for row in want)


def test_edits_are_all_strings_one_edit_away():
    alphabet = np.arange(1, 4, dtype=np.uint64)
    words = [[1], [1, 1, 2], [3, 2, 1, 1, 1], [2, 2, 2, 2]]
    hash_of = lambda w: int(spelling._word_hash(np.array(w, np.uint64), np.array([0, len(w)]))[0])
    code, offsets = np.array(sum(words, []), np.uint64), np.cumsum([0, *map(len, words)])
    for full in (True, False):
        got = {i: set() for i in range(len(words))}
        for owner, near in spelling.edits(code, offsets, alphabet, full):
            for i, h in zip(owner.tolist(), near.tolist()):
                got[i].add(h)
        for i, w in enumerate(words):
            shorter = {tuple(w[:p] + w[p + 1 :]) for p in range(len(w))}
            replaced = {tuple(w[:p] + [c] + w[p + 1 :]) for p in range(len(w)) for c in (1, 2, 3)}
            raised = {tuple(w[:p] + [c] + w[p + 1 :]) for p in range(len(w)) for c in (1, 2, 3) if c > w[p]}
            longer = {tuple(w[:p] + [c] + w[p:]) for p in range(len(w) + 1) for c in (1, 2, 3)}
            want = {tuple(w)} | shorter | (replaced | longer if full else raised)
            assert got[i] == {hash_of(list(x)) for x in want}


def test_a_path_of_forms(spark):
    chain = {"holidays": 2, "holidaysx": 20, "holidaysxy": 200, "holidaysxyz": 2000, "holidayszxyz": 20000}
    rows = spark.createDataFrame([(w, n, 0, f, chain.get(f)) for (w, n), f in zip(chain.items(), [*list(chain)[1:], None])],
                                 "word string, n long, n_near long, form string, form_n long")
    assert {r["word"]: r["root"] for r in spelling.with_roots(rows).collect()} == dict.fromkeys(chain, "holidayszxyz")
    assert {r["form"] for r in spelling.forms(rows.select("word", "n")).collect()} == {*list(chain)[1:], None}


def test_very_long_words(spark):
    long = "abcdefghij" * 20_000
    docs = [(1, f"{long} {long}"), (2, f"{long[:5000]}{long[5001:]} {long[:5000]}{long[5001:]}"), (3, " ".join([long + "z"] * 40))]
    got = {(r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(frame(spark, docs)).collect()}
    want = {(n, near, form_n) for _, _, _, n, near, form_n in brute(docs)}
    assert got == want


def test_odd_and_empty_tables(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    assert {tuple(r) for r in spelling.variants(odd_documents).collect()} == brute(rows)
    assert spelling.variants(no_documents).count() == 0
    assert spelling.variants(no_documents).columns == ["word", "form", "root", "n", "n_near", "form_n"]
