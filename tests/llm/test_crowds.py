"""Near duplicates where very many texts share buckets though few of them are similar enough."""

import random

import pytest

from shelfmark.llm import neardup


def mould(n, own, seed=3):
    """Texts of one mould, each with words of its own, some of them with a near copy."""
    random.seed(seed)
    common = [f"c{i}" for i in range(180)]
    rows = []
    for i in range(n):
        words = common + [f"o{i}x{j}" for j in range(own)]
        rows.append((2 * i, " ".join(words)))
        if i % 10 == 0:
            rows.append((2 * i + 1, " ".join(words[:-2] + [f"e{i}"] * 2)))
    random.shuffle(rows)
    return rows


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(rows):
    sets = {i: shingles(t) for i, t in rows}
    found = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b]) if a < b else 0
            if a < b and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                old, new = max(found[a], found[b]), min(found[a], found[b])
                found = {k: new if v == old else v for k, v in found.items()}
    return found


@pytest.mark.parametrize(("own", "together"), [(27, 3), (24, 0), (30, 100)])
def test_a_mould_equals_brute_force(spark, monkeypatch, own, together):
    """With buckets taken apart by rare shingles, whole, and mixed."""
    monkeypatch.setattr(neardup, "TOGETHER", together)
    rows = mould(120, own)
    # Two larger groups of near copies in the same mould, which stay apart from each other.
    for group in range(2):
        words = rows[group][1].split()
        rows += [(5000 + 100 * group + i, " ".join([*words[:-1], f"g{group}v{i}"])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert found == components(rows)


def test_a_mould_makes_few_pairs(spark, monkeypatch):
    """2,200 texts at 0.77 to each other: the pairs that rare shingles make are the planted ones alone."""
    rows, made = mould(2000, 26), []
    a, b = (shingles(t) for i, t in sorted(rows) if i in (2, 4))
    assert 0.7 < len(a & b) / len(a | b) < 0.79
    sharing = neardup._sharing

    def counted(*given):
        pairs = sharing(*given)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(neardup, "_sharing", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert found == {i: i - i % 2 for i, _ in rows}
    assert made and made[0] <= 200
