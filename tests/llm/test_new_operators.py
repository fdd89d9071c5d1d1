"""The filter audit, the cover tree and the multi-index against brute force, and their edge cases."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from shelfmark.llm import audit, covertree, mixing, multiindex
from shelfmark.llm import text as T

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")


# Filter audit


def brute_counts(text):
    text = text or ""
    words = PLAIN.findall(text)
    return (
        len(words), len(set(words)), sum("A" <= c <= "Z" for c in text), len(text), sum(c in "#$%&*|" for c in text),
    )


@pytest.fixture(scope="module")
def odd_texts():
    draw = random.Random(3)
    words = ["a", "A", "Ab", "日本", "é", "x" * 17, "x" * 16 + "y", "y" + "x" * 16, "#1", "w" * 5000, "w" * 4999 + "v", "🙂", "\x00", "NASA"]
    made = [" ".join(draw.choices(words, k=draw.randint(0, 90))) for _ in range(120)]
    long = "\n".join(f"Line {i} of {i % 7000}" for i in range(60_000)) + "z" * 300_000
    return [None, "", " \t\n", "x", *made, made[0], made[1], "plain words " * 40, "plain words " * 40, long]


def test_counts_of_one_pass(odd_texts):
    import pyarrow as pa

    data, bounds = T.rows(pa.array(odd_texts, pa.string()))
    assert list(zip(*map(list, audit.counts(data, bounds)))) == [brute_counts(x) for x in odd_texts]


def test_hash_table_tells_words_apart_that_share_a_slot(monkeypatch):
    """With one hash for everything only the verification of bytes is left."""
    monkeypatch.setattr(audit.Words, "hashes", lambda self: np.zeros(len(self.starts), np.uint64))
    data = np.frombuffer(b"ab abc ab abd abcdefghijklmnopqrs abcdefghiXklmnopqrs abcdefghijklmnopqrs", np.uint8)
    assert [int(x[0]) for x in audit.counts(data, np.array([0, len(data)]))][:2] == [7, 5]


def brute_audit(rows, labels):
    """Applies each order to each document, one filter after the other."""
    by_text = defaultdict(list)
    for id, text, _ in rows:
        if id is not None:
            by_text[text or ""].append(id)
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))
    fails, found = [], Counter()
    for id, text, _ in rows:
        words, distinct, capitals, points, symbols = brute_counts(text)
        copy = id is not None and any(x < id for x in by_text[text or ""])
        fails.append({
            c for c, bad in zip("ABCDE", (words < 50, 100 * distinct < 65 * words, 100 * capitals > 5 * points, symbols > 0, copy)) if bad
        })
    orders = ["".join(p) for p in permutations("ABCDE")]
    for part in {r[2] or "" for r in rows}:
        for order in orders:
            for step in range(1, 6):
                found[part, order, step] = [0] * 6
    shapley = Counter()
    for (id, _, part), bad in zip(rows, fails):
        part = part or ""
        for order in orders:
            gone = next((i for i, c in enumerate(order, 1) if c in bad), 6)
            if gone < 6:
                shapley[part, order[gone - 1]] += 1
            for step in range(1, 6):
                x, own = found[part, order, step], order[step - 1]
                x[0] += gone > step
                x[1] += gone == step
                x[2] += own in bad and gone < step
                x[3] += bad == {own}
                x[4] += gone == step and id in good
                x[5] += gone == step and id in toxic
    return Counter((part, order, step, *x, shapley[part, order[step - 1]]) for (part, order, step), x in found.items())


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit(spark, odd_texts):
    draw = random.Random(8)
    parts = ["s0", "s0", "s1", "", None]
    rows = [(i, t, draw.choice(parts)) for i, t in enumerate(odd_texts[:-1])]
    # A copy under a smaller id, without an id, a repeated row, one id for two texts.
    rows += [(-5, odd_texts[9], "s1"), (None, odd_texts[9], "s1"), (None, None, None), (4, odd_texts[4], "s0"), (4, odd_texts[4], "s0"), (7, "other", "s0")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(60)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, n_words int, copy int").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert Counter(map(tuple, audit.audit(docs, marks).select(*COLUMNS).collect())) == brute_audit(rows, labels)
    assert audit.audit(docs.limit(0), marks).count() == 0
    assert audit.audit(docs, marks.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_audit_takes_other_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "a b", "s"), (3, "A", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = audit.audit(docs, labels, filters={"u": "n_capitals > 0", "e": "copy"})
    assert sorted((r.filter_order, r.step, r.kept, r.removed) for r in found.collect()) == [
        ("eu", 1, 2, 1), ("eu", 2, 1, 1), ("ue", 1, 2, 1), ("ue", 2, 1, 1)]
    with pytest.raises(ValueError):
        audit.audit(docs, labels, filters={})


# Cover tree


def clouds(seed, n=700, dim=12):
    """Tight groups, equal rows, scaled rows and scattered ones."""
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(9, dim))
    rows = np.concatenate([
        draw.normal(size=(n // 3, dim)), centers[draw.integers(0, 9, n // 3)] + draw.normal(scale=0.14, size=(n // 3, dim)),
        centers[0] + draw.normal(scale=0.1, size=(n // 3, dim)),
    ])
    return np.concatenate([rows, rows[:40], rows[40:60] * 2.0, rows[60:70] * 1e30]).astype(np.float32).astype(np.float64)


@pytest.mark.parametrize("cosine", [0.98, 0.9, 0.5])
def test_tree_walk_is_exact(cosine):
    raw = clouds(1)
    direct = covertree.unit(covertree.scaled(raw))
    near = direct @ direct.T >= cosine
    np.fill_diagonal(near, False)
    weights = np.random.default_rng(2).integers(1, 5, len(raw))
    count, root = covertree.linked(raw, weights, np.zeros(len(raw), np.int64), cosine)
    assert (count == near @ weights).all()
    for i, j in np.argwhere(near):
        assert root[i] == root[j]
    for i in np.flatnonzero(root != np.arange(len(root))):  # what hangs together is linked by steps
        reach, new = {i}, {i}
        while new:
            new = {int(j) for k in new for j in np.flatnonzero(near[k])} - reach
            reach |= new
        assert min(reach) == root[i]
    side = np.random.default_rng(3).integers(0, 2, len(raw))
    count, _ = covertree.linked(raw, weights, side, cosine, within=False)
    assert (count == (near & (side[:, None] != side[None, :])) @ weights).all()


def test_tree_covers_and_halves():
    points = covertree.unit(clouds(4))
    tree = covertree.Tree(points)
    assert sorted(tree.order) == list(range(len(points)))
    for node, (low, high) in enumerate(tree.span):
        own = points[tree.order[low:high]]
        assert covertree.apart(own @ points[tree.center[node]]).max() <= tree.radius[node] + 1e-7
        below = tree.children[node]
        if below:
            assert tree.center[below[0]] == tree.center[node]
            assert sorted(s for i in below for s in range(*tree.span[i])) == list(range(low, high))
            gaps = covertree.apart(points[[tree.center[i] for i in below]] @ points[[tree.center[i] for i in below]].T)
            np.fill_diagonal(gaps, 9)
            assert gaps.min() > max(tree.radius[i] for i in below) * 0.999  # centres lie apart by more than they cover


def brute_vectors(rows, cosine):
    def ready(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    root = list(range(len(rows)))
    links = [0] * len(rows)
    for i, (_, a, x) in enumerate(rows):
        for j, (_, b, y) in enumerate(rows[:i]):
            if a is not None and a == b and ready(x) and ready(y) and len(x) == len(y):
                p, q = (np.array(v, np.float64) / max(map(abs, v)) for v in (x, y))
                if covertree.cosine_of(p, q) >= cosine:
                    links[i], links[j] = links[i] + 1, links[j] + 1
                    old, new = root[i], root[j]
                    root = [new if r == old else r for r in root]
    out = Counter()
    for i, row in enumerate(rows):
        ids = [r[0] for k, r in enumerate(rows) if root[k] == root[i] and r[0] is not None]
        low = min(ids, default=None)
        out[row[0], links[i], low, row[0] is not None and row[0] == low] += 1
    return out


@pytest.fixture
def small_cells(monkeypatch):
    """Many pivots, visitors and several blocks of one cell on a small table."""
    monkeypatch.setattr(covertree, "CELL", 40)
    monkeypatch.setattr(covertree, "BLOCK", 25)


def test_near_vectors(spark, small_cells):
    draw = np.random.default_rng(7)
    vectors = clouds(5, 420, 6).tolist()
    rows = [(i, [0, 0, 0, 1, 2, None][draw.integers(0, 6)], v) for i, v in enumerate(vectors)]
    rows += [
        (1000, 0, None), (1001, 0, []), (1002, 0, [0.0] * 6), (1003, 0, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1004, 0, [math.nan] * 6),
        (1005, 0, [math.inf] * 6), (1006, 0, [1.0, 2.0]), (1007, 0, [2.0, 4.0]), (None, 0, [1.0, 2.0]), (None, 2, [1.0, 2.0]), (None, None, None),
        (3, 0, vectors[3]), (3, 0, vectors[3]), (5, 1, vectors[9]), (1008, 1, [1e-42] * 6), (1009, 1, [2e-42] * 6),
    ]
    rows = [(a, b, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for a, b, v in rows]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, key string, n int").repartition(3)
    got = covertree.near_vectors(frame)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert Counter(map(tuple, got.collect())) == brute_vectors(rows, 0.98)
    assert covertree.near_vectors(frame.limit(0)).count() == 0


# Multi-index


def brute_negatives(rows, positives, negatives, least, most):
    alike = {(i, l, tuple(v)): a for i, l, v, a in rows if None not in (i, l, v) and None not in v}
    for i, l, v, a in rows:  # an anchor if any of the rows that are alike is one
        if None not in (i, l, v) and None not in v and a:
            alike[i, l, tuple(v)] = True
    found = Counter()
    for own, is_anchor in alike.items():
        if not is_anchor:
            continue
        scored = sorted((-sum(x * y for x, y in zip(own[2], o[2])), o[0], o) for o in alike if o != own)
        for down, pid, _ in [x for x in scored if x[2][1] == own[1]][:positives]:
            fit = [(n, i) for n, i, o in scored if o[1] != own[1] and least * -down <= 100 * -n <= most * -down][:negatives]
            for rank, (n, i) in enumerate(fit, 1):
                found[own[0], pid, rank, i, -down, -n] += 1
    return found


@pytest.mark.parametrize("dim, spread", [(8, 1.0), (5, 0.2), (1, 1.0)])
def test_hard_negatives(spark, monkeypatch, dim, spread):
    monkeypatch.setattr(multiindex, "CELL", 8)
    monkeypatch.setattr(multiindex, "BLOCK", 60)
    monkeypatch.setattr(multiindex, "ANCHORS", 9)
    draw = np.random.default_rng(dim)
    centers = draw.normal(size=(6, dim))
    made = np.floor(60 * (centers[draw.integers(0, 6, 500)] + spread * draw.normal(size=(500, dim)))).astype(int).tolist()
    rows = [(i, int(draw.integers(0, 4)), v, i % 20 == 0) for i, v in enumerate(made)]
    rows += [(600 + i, int(draw.integers(0, 3)), made[0], False) for i in range(80)]  # ties
    rows += [
        (700, None, made[0], True), (None, 1, made[0], True), (701, 1, None, True), (702, 1, [None] * dim, True), (703, 9, made[1], True),
        (704, 1, [], True), (20, 1, made[5], True), rows[40], rows[40], (705, 1, made[2] + [7, 7], True), (706, 2, made[3][:1], None),
        (707, 0, [0] * dim, True),
    ]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, label int, vector array<int>, anchor boolean, score int, ask string").repartition(4)
    got = multiindex.hard_negatives(frame)
    assert Counter(map(tuple, got.collect())) == brute_negatives(rows, 5, 3, 50, 95)
    assert multiindex.hard_negatives(frame.limit(0)).count() == 0
    assert multiindex.hard_negatives(frame.where("not anchor")).count() == 0


def test_scores_past_exact_doubles():
    rows = np.array([[2.0**40, 2.0**20, 1.0], [1.0, 1.0, 1.0], [2.0**60, 2.0**60, 2.0**60]])
    anchor = np.array([2.0**20, 1.0, 3.0])
    assert multiindex.scores(rows, anchor).tolist() == [2**60 + 2**20 + 3, 2**20 + 4, (1 << 63) - 1]


def test_cells_come_in_order_of_bounds():
    draw = np.random.default_rng(1)
    left, right = draw.normal(size=7), draw.normal(size=5)
    seen = list(multiindex.cells_by_bound(left, right))
    assert [x[0] for x in seen] == sorted((x[0] for x in seen), reverse=True)
    assert {x[1:] for x in seen} == {(a, b) for a in range(7) for b in range(5)}
    assert all(math.isclose(x, left[a] + right[b]) for x, a, b in seen)


# Positions of the curriculum


def test_positions_are_the_order_of_moments(spark):
    draw = random.Random(2)
    rows = [(i, " ".join(["w"] * draw.randint(0, 30)), draw.choice(["a", "b", "b", None]), 1) for i in range(200)]
    rows += [(5, rows[5][1], rows[5][2], 1), (None, "no id", "a", 1), (None, "no id", "a", 1), (7, None, "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, position int").repartition(4)
    mixed = mixing.mix(docs, keep=["doc_id", "position"])
    want = [(r.doc_id, m) for r in mixed.collect() for m in r["mix"].moments]
    want.sort(key=lambda x: (x[1], x[0] is None, x[0] or 0))
    found = mixing.positions(mixed).collect()
    assert len(found) == len(rows) and Counter(len(r.positions) for r in found) == Counter(len(r["mix"].moments) for r in found)
    placed = sorted((p, r.doc_id, m) for r in found for p, m in zip(r.positions, sorted(r["mix"].moments)))
    assert [p for p, _, _ in placed] == list(range(1, len(want) + 1))
    assert [(i, m) for _, i, m in placed] == want
    assert mixing.positions(mixing.mix(docs.limit(0))).count() == 0
