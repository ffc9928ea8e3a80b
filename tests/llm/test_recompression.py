import random
import re

import numpy as np
import pytest
from documents_llm import no_documents, odd_documents, prose  # noqa: F401

from tickloom.llm import recompression
from tickloom.llm.common import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, width):
    """The contract in plain Python: the kept text of each row."""
    first, parsed = {}, []
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        rank = 1 << 63 if doc_id is None else doc_id
        parsed.append((rank, words))
        for i in range(len(words) - width + 1):
            w = tuple(words[i : i + width])
            first[w] = min(first.get(w, rank), rank)
    out = []
    for rank, words in parsed:
        gone = {j for i in range(len(words) - width + 1) if first[tuple(words[i : i + width])] < rank for j in range(i, i + width)}
        out.append((len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return out


def same(spark, docs, width, frame=None):
    frame = frame or spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string")
    got = recompression.without_repeats(frame, width=width)
    rows = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()))
    want = sorted((i is None, i or 0, *row) for (i, _), row in zip(docs, brute(docs, width)))
    assert rows == want
    return rows


@pytest.mark.parametrize("width", [3, 4, 7, 50])
def test_few_words_many_repeats(spark, width):
    """Random texts over few words, among them long runs, periods and shared passages."""
    r = random.Random(width)
    passages = [" ".join(r.choices("abcdef", k=r.randint(width, 3 * width))) for _ in range(6)]
    passages += [" ".join(["a"] * 3 * width), " ".join(["a", "b"] * 2 * width), " ".join(["a", "b", "c"] * 2 * width)]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(r.randint(0, 5)):
            parts.append(r.choice([r.choice(passages), " ".join(r.choices("abcdefgh", k=r.randint(0, 2 * width)))]))
        docs.append((i, r.choice([" ", "\n", " \t "]).join(parts)))
    rows = same(spark, docs, width)
    assert any(row[3] for row in rows) and any(0 < row[3] < row[2] for row in rows)


def test_edits_at_every_place(spark):
    """Copies of one text, each with one word changed, dropped or added: every edge of a repeat is exact."""
    words = prose(3, 160).split()
    docs = [(1000, " ".join(words))]
    for i in range(0, 160, 7):
        docs += [(i, " ".join([*words[:i], "changed", *words[i + 1 :]])), (i + 1, " ".join(words[:i] + words[i + 1 :])),
                 (i + 2, " ".join([*words[:i], "added", *words[i:]])), (i + 3, " ".join(words[i : i + 60]))]
    same(spark, docs, 50)


def test_small_chunks_change_nothing(spark, monkeypatch):
    text = prose(8, 900)
    docs = [(1, text), (2, prose(9, 70) + " " + text[500:3000]), (3, text[200:] + " " + prose(10, 60))]
    want = same(spark, docs, 50)
    names = mix(np.arange(500, dtype=np.uint64) // np.uint64(3))
    starts = np.arange(451)
    whole = recompression.blocks(names, starts, 50)
    monkeypatch.setattr(recompression, "CHUNK", 64)
    parts = recompression.blocks(names, starts, 50)
    assert whole[3].sum() == parts[3].sum() == 451 and set(whole[0]) == set(parts[0])
    assert same(spark, docs, 50) == want


@pytest.mark.parametrize("letters", [1, 2, 3, 50, 1000])
def test_parse_depends_on_the_window_alone(letters):
    r = np.random.default_rng(letters)
    window = mix(r.integers(0, letters, 50).astype(np.uint64))
    results = set()
    for _ in range(30):
        before, after = (mix(r.integers(0, letters, r.integers(0, 90)).astype(np.uint64)) for _ in range(2))
        words = np.concatenate([before, window, after])
        name, place, spelling = recompression.parse(words, np.array([len(before)]))
        results.add((int(name[0]), int(place[0]) - len(before), int(spelling[0])))
        assert 0 <= place[0] - len(before) < 50
    assert len(results) == 1


def test_spellings_differ_where_windows_do():
    r = np.random.default_rng(4)
    words = mix(r.integers(0, 3, 30_000).astype(np.uint64))
    starts = np.arange(len(words) - 12 + 1)
    _, _, spelling = recompression.parse(words, starts, 12)
    other = recompression.polynomial(words, starts, 12)
    contents = np.lib.stride_tricks.sliding_window_view(words, 12)
    distinct = len(np.unique(contents, axis=0))
    assert len(np.unique(spelling)) == len(np.unique(other)) == distinct


def test_rounds_shorten_the_sequence():
    words = mix(np.random.default_rng(5).integers(0, 500, 20_000).astype(np.uint64))
    named, run, begin = recompression.name_runs(words)
    assert len(named) == (words[1:] != words[:-1]).sum() + 1 and (words[begin][run] == words).all()
    joined, place, kept = recompression.name_pairs(named, recompression.sides(named, 0))
    assert 0.7 < len(joined) / len(named) < 0.8 and place[-1] == len(joined) - 1 and len(kept) == len(joined)


def test_a_hot_passage_is_one_block_per_content(spark):
    passage = prose(1, 80)
    docs = [(i, f"{prose(100 + i, 30)} {passage} {prose(900 + i, 30)}") for i in range(60)]
    rows = same(spark, docs, 50)
    assert sum(row[3] > 0 for row in rows) == 59


def test_odd_and_empty_tables(spark, odd_documents, no_documents):
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    same(spark, docs, 50, odd_documents)
    got = recompression.without_repeats(no_documents)
    assert got.count() == 0 and got.columns == ["doc_id", "kept", "n_words", "n_removed"]
