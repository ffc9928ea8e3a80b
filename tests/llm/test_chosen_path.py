import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from documents_llm import no_documents, odd_documents, prose  # noqa: F401
from pyspark.sql import functions as F

from tickloom.llm import chosen_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    words = WORD.findall(text or "")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def by_brute_force(rows):
    """Least id of the class, and the number of links, per row."""
    sets = [grams(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        same = (rows[i][1] or "") == (rows[j][1] or "")
        if same or (common and 5 * common >= 4 * len(sets[i] | sets[j])):
            links[i] += 1
            links[j] += 1
            a, b = sorted((find(i), find(j)))
            root[b] = a
    classes = {}
    for i in range(len(rows)):
        classes.setdefault(find(i), []).append(rows[i][0])
    return [(rows[i][0], min((d for d in classes[find(i)] if d is not None), default=None), links[i]) for i in range(len(rows))]


def corpus():
    r = random.Random(8)
    passage = prose(500, 40)
    rows, n = [], itertools.count()
    for g in range(25):
        base = prose(600 + g, r.randint(5, 200)).split()
        for _ in range(r.choice([1, 2, 3, 6])):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                words[r.randrange(len(words))] = f"w{next(n)}"
            rows.append((next(n), " ".join(words)))
    rows += [(next(n), passage + " " + prose(900 + i, 60)) for i in range(90)]  # a common passage makes no copies
    hot = prose(1500, 150).split()
    for i in range(130):  # a large group of near copies
        words = list(hot)
        words[i] = f"x{i}"
        rows.append((next(n), " ".join(words)))
    rows += [(next(n), "the same text again and again for all of them") for _ in range(60)]
    rows += [(next(n), t) for t in ("a", "a", "a b", "a b c d", "a  b c d", "", None, " ", "a b c d e")]
    return rows + [rows[0], (None, rows[1][1]), (None, None)]


def test_classes_and_links_against_all_pairs(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = chosen_path.join(docs).collect()
    key = lambda t: (t[0] is None, t[0] or 0, t[1] is None, t[1] or 0, t[2])
    want = sorted(by_brute_force(rows), key=key)
    assert sorted([(r["doc_id"], r["class_id"], r["n_links"]) for r in got], key=key) == want
    assert sum(r["is_first"] for r in got) == len({r["class_id"] for r in got if r["class_id"] is not None}) + sum(
        r["class_id"] is None and r["is_first"] for r in got)
    # Cut into small blocks, the counts are the same.
    monkeypatch.setattr(chosen_path, "BLOCK_TEXTS", 30)
    again = chosen_path.join(docs).collect()
    assert sorted([(r["doc_id"], r["class_id"], r["n_links"]) for r in again], key=key) == want


def test_blocks_without_members_add_no_links(spark, monkeypatch):
    rows = []
    for g in range(12):  # a few long near copies, most blocks of theirs empty
        words = prose(2000 + g, 150).split()
        rows += [(len(rows) + k, " ".join([*words[:-1], f"end{k}"])) for k in range(2 + g % 2)]
    monkeypatch.setattr(chosen_path, "BLOCK_TOKENS", 100)
    got = chosen_path.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == by_brute_force(rows)
    assert all(r["n_text_links"] == r["n_links"] for r in got)


def test_pairs_of_common_shingles_are_found_through_many_splits(spark, monkeypatch):
    r = np.random.default_rng(11)
    universe = r.integers(1, 1 << 62, 1600).astype(np.uint64)
    sets = []
    for _ in range(1000):  # a set and four fifths of it, each token in a quarter of all sets
        whole = r.choice(universe, 400, replace=False)
        sets += [np.sort(whole), np.sort(whole[:320])]
    tokens, before = np.concatenate(sets), np.append(0, np.cumsum([len(x) for x in sets]))
    first, runs = chosen_path.runs_for(chosen_path.RECALL, splits=0), chosen_path.runs_for(chosen_path.RECALL)
    paths, more = (chosen_path._paths(tokens, before, r) for r in (range(first), range(first, runs)))
    rows = [(i, len(x), k.tobytes(), p.tolist(), m.tolist()) for i, (x, k, p, m) in enumerate(zip(sets, chosen_path.sketches(tokens, before), paths, more, strict=True))]
    monkeypatch.setattr(chosen_path, "SMALL", 3)
    ties = chosen_path.candidates(spark.createDataFrame(rows, "node long, tokens long, sketch binary, paths array<bigint>, more array<bigint>"))
    root = {g["node"]: g["root"] for g in chosen_path.components(ties).collect()}
    missed = sum(root.get(i, i) != root.get(i + 1, i + 1) for i in range(0, len(rows), 2))
    assert missed <= 2 and len(set(root.values())) > 900


def test_runs_follow_from_all_splits():
    assert chosen_path.missed(chosen_path.runs_for(chosen_path.RECALL), chosen_path.DEPTH - 1) <= 1 - chosen_path.RECALL
    assert chosen_path.missed(8, 0) < 0.0005 < chosen_path.missed(8, 1) < chosen_path.missed(8, 6)


def test_one_document_of_each_class_stays(odd_documents, no_documents):
    kept = chosen_path.deduplicated(odd_documents)
    assert kept.columns == odd_documents.columns
    texts = [r["text"] or "" for r in kept.select("text").collect()]
    assert sorted(t for t in texts if t.strip()) == sorted({r["text"] for r in odd_documents.collect() if (r["text"] or "").strip()})
    assert len(texts) == len(set(texts))
    assert chosen_path.join(no_documents).count() == 0


def test_runs_reach_the_recall():
    assert chosen_path.runs_for(0.5) < chosen_path.runs_for(0.99) < chosen_path.runs_for(0.99999)
    words = [f"w{i}" for i in range(400)]
    texts, pairs = [], 300
    for i in range(pairs):  # pairs at the least similarity: 400 shingles, 44 or 45 of them changed on each side
        base = [f"{i}.{w}" for w in words]
        texts += [" ".join(base), " ".join([*base[:360], *[w + "'" for w in base[360:]]])]
    tokens, before = chosen_path.shingles(pa.array(texts))
    a, b = (set(tokens[before[k] : before[k + 1]].tolist()) for k in (0, 1))
    assert 0.8 <= len(a & b) / len(a | b) < 0.83
    met = {runs: 0 for runs in (2, chosen_path.runs_for(0.99))}
    for runs in met:
        paths = chosen_path._paths(tokens, before, range(runs))
        met[runs] = np.mean([bool(np.intersect1d(paths[2 * i], paths[2 * i + 1]).size) for i in range(pairs)])
    assert met[2] > 0.7 and met[chosen_path.runs_for(0.99)] >= 0.98


def test_components_against_union_find(spark):
    r = random.Random(6)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(120)] + [(5000, 5001 + i) for i in range(50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {g["node"]: g["root"] for g in chosen_path.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


@pytest.mark.parametrize("depth", [1, 2, 7])
def test_short_texts_with_a_common_line_are_not_tied(spark, monkeypatch, depth):
    """The line is in all of them, which makes buckets that are split, and compared in blocks at the last level."""
    line, dice = " ".join(f"common{i}" for i in range(12)), random.Random(depth)
    texts = [f"{line} " + " ".join(f"{i}x{k}" for k in range(8)) for i in range(600)]
    texts += [t.replace(f"{i}x7", "changed") for i, t in enumerate(texts[:100])]  # linked to the first hundred
    dice.shuffle(texts)
    monkeypatch.setattr(chosen_path, "SMALL", 100)
    monkeypatch.setattr(chosen_path, "BLOCK_SETS", 90)
    monkeypatch.setattr(chosen_path, "DEPTH", depth)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = chosen_path._prepare(docs, chosen_path.RECALL).select(F.col("doc_id").alias("node"), "tokens", "sketch", "paths", "more")
    sizes = chosen_path.components(chosen_path.candidates(rows)).groupBy("root").count().collect()
    assert len(sizes) >= 99 and max(r["count"] for r in sizes) <= 3


def test_differing_bins_never_exclude_a_link():
    r = np.random.default_rng(8)
    for size in (5, 9, 16, 45, 128, 700):
        for _ in range(60):
            whole = r.integers(1, 1 << 62, size).astype(np.uint64)
            other = np.concatenate([whole[: size - size // 10], r.integers(1, 1 << 62, r.integers(0, size // 10 + 1)).astype(np.uint64)])
            common = len(set(whole.tolist()) & set(other.tolist()))
            if 9 * common < 4 * (len(whole) + len(other)):
                continue
            both = [np.sort(whole), np.sort(other)]
            sketch = chosen_path.sketches(np.concatenate(both), np.append(0, np.cumsum([len(x) for x in both])))
            assert 9 * chosen_path._differ(sketch[:1], sketch[1:])[0] <= len(whole) + len(other)


def test_sets_that_left_at_a_pivot_are_in_no_further_buckets(spark, monkeypatch):
    """Only sets that go on from a split bucket need further runs; of near copies and strangers with a common line, the strangers."""
    hot, line = prose(3000, 300).split(), prose(3001, 24)
    texts = [" ".join([*hot[:i], f"x{i}", *hot[i + 1 :]]) for i in range(200)]
    texts += [f"{line} " + " ".join(f"{i}y{k}" for k in range(30)) for i in range(200)]
    seen, stored = [], chosen_path._buckets
    monkeypatch.setattr(chosen_path, "_buckets", lambda members: (seen.append(members.groupBy("node").count().collect()), stored(members))[1])
    monkeypatch.setattr(chosen_path, "SMALL", 40)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = chosen_path._prepare(docs, chosen_path.RECALL).withColumn("node", F.col("doc_id"))
    found = {g["node"]: g["root"] for g in chosen_path.components(chosen_path.candidates(rows)).collect()}
    assert found == dict.fromkeys(range(200), 0)
    assert len(seen) > 1 and {r["node"] for r in seen[0]} == set(range(400))
    later = {r["node"] for counts in seen[1:] for r in counts}
    assert len(later) > 50 and min(later) >= 200


def test_members_of_large_buckets_are_joined_with_their_counts_alone_by_bucket(spark, monkeypatch):
    seen, split = [], chosen_path._split_large
    monkeypatch.setattr(chosen_path, "_split_large", lambda rows, level: (seen.append(rows._jdf.queryExecution().executedPlan().toString()), split(rows, level))[1])
    monkeypatch.setattr(chosen_path, "SMALL", 20)
    hot = prose(3002, 100).split()
    docs = spark.createDataFrame([(i, " ".join([*hot, f"x{i}"])) for i in range(60)], "doc_id long, text string")
    assert {r["n_links"] for r in chosen_path.join(docs).collect()} == {59}
    joins = [x for plan in seen for x in plan.splitlines() if "Join" in x]
    assert joins and not any("[path#" in x for x in joins)


def test_components_end_without_a_round_that_changes_nothing(spark, monkeypatch):
    stored, tables = chosen_path.materialise, []
    monkeypatch.setattr(chosen_path, "materialise", lambda df, label: (tables.append(label), stored(df, label))[1])
    stars = [(10 * i, 10 * i + k) for i in range(9) for k in range(1, 5)]
    got = {g["node"]: g["root"] for g in chosen_path.components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert got == {**dict((b, a) for a, b in stars), **{a: a for a, _ in stars}}
    assert tables == ["edges"]
