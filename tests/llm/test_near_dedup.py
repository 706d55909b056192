import itertools
import random
import re

import numpy as np
import pytest

from kelpline.llm import near_dedup as N
from kelpline.llm.common import Scratch
from kelpline.llm.superminhash import band_hashes, signatures

UPPER = re.compile("[A-Z]")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", UPPER.sub(lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if 4 * min(len(sets[i]), len(sets[j])) < 3 * max(len(sets[i]), len(sets[j])):
            continue
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
            up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: (len(sets[i]), d if not sets[i] else least[root(i)]) for i, (d, _) in enumerate(rows)}


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Ünë", "Ab", "ab"]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One TWO"), (6, "one")]
    shared = [rng.choice(words) for _ in range(60)]
    for k in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([4, 5, 6, 40, 200]))] + shared * (k % 2)
        for _ in range(rng.choice([1, 2, 15])):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((100 + len(rows), " ".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "groups"), [(1, N.GROUPS), (2, (2, None)), (3, (None,))])
def test_components_against_all_pairs(spark, seed, groups):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, "x", 0, b"k") for d, t in rows], "doc_id bigint, text string, n string, bands int, node binary")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_dedup(docs, groups=groups).collect()}
    assert got == brute(rows)


def test_keeps_one_of_each_and_all_columns(spark):
    docs = spark.createDataFrame([(3, "a b c d e f", "s"), (1, "A b c d e f", None), (2, None, "s"), (2, None, "s")], "doc_id bigint, text string, source string")
    out = N.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 2]


def test_near_copies_without_an_id(spark):
    text = lambda k, own="": " ".join([*(f"{k}{i}" for i in range(40)), own])
    # b and d: near copies of rows with ids, in classes whose ids are all null; c: two near copies without any id; d: linked through such a class only
    far = [f"d{i}" for i in range(60)]
    rows = [(7, text("b")), (None, text("b", "x")), (None, text("c")), (None, text("c", "y")), (None, text("e")), (9, " ".join(far[:50])), (None, " ".join(far[5:55])), (8, " ".join(far[10:])), (None, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, node_ int")
    near = N.near_dedup(docs).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in near} == {(7, 7, True), (None, 7, False), (None, None, True), (9, 8, False), (None, 8, False), (8, 8, True)}
    out = N.keep_one(docs)
    assert out.columns == docs.columns
    left = sorted(r.node_ for r in out.collect())
    assert len(set(left) & {2, 3}) == 1  # of two near copies without any id
    assert [x for x in left if x not in (2, 3)] == [0, 4, 7, 8]


def test_drops_rows_and_not_ids(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(50)) for k in "abc")
    rows = [(1, a), (5, b), (5, a), (5, a + " more"), (7, c), (7, c + " more"), (7, c), (None, c), (None, None), (9, None), (9, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, gone_id int")
    left = sorted(r.gone_id for r in N.keep_one(docs).collect())
    # 5 with a text of its own stays, 5 with copies of 1 goes; of two texts of 7 one stays, with the row that repeats it
    assert left in ([0, 1, 4, 6, 8, 9, 10], [0, 1, 5, 8, 9, 10])


@pytest.mark.parametrize(("own", "low", "high"), [(26, 0.5, 0.62), (20, 0.6, 0.7), (14, 0.68, 0.75)])
def test_rows_that_meet_for_a_template_grow_linearly(spark, monkeypatch, own, low, high):
    """n texts of one template, each with words of its own, and none are linked: rows are counted as they come out of the join, before any filter."""
    template, seen = [f"t{i}" for i in range(84)], {}
    verified, meetings = N._verified, N._meetings
    for n in (500, 1000, 2000):
        met, compared = seen.setdefault(n, ([], []))
        monkeypatch.setattr(N, "_verified", lambda pairs, *a, compared=compared: (compared.append(pairs.count()), verified(pairs, *a))[1])
        monkeypatch.setattr(N, "_meetings", lambda rows, *a, met=met: (met.append((x := meetings(rows, *a)).count()), x)[1])
        texts = [" ".join([*template, *(f"o{k}x{i}" for i in range(own))]) for k in range(n)]
        assert low < len(shingles(texts[0]) & shingles(texts[1])) / len(shingles(texts[0]) | shingles(texts[1])) < high
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        assert N.near_dedup(docs).where("not kept").isEmpty()
    print({n: (sum(m), sum(c)) for n, (m, c) in seen.items()})
    # each text with the leader of its 32 buckets at most
    assert all(sum(m) <= n and sum(c) <= 33 * n for n, (m, c) in seen.items()) and sum(seen[2000][1]) <= 4.5 * sum(seen[500][1])


def test_all_links_of_a_real_table_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    expected = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_dedup(docs).collect()}
    linked = [d for d, (_, c) in expected.items() if c != d]
    print("recall", sum(got[d] == expected[d] for d in linked) / len(linked), "of", len(linked))
    assert got == expected


def test_empty(spark):
    assert N.near_dedup(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_long_paths_and_stars(spark):
    rng = random.Random(5)
    nodes = [rng.randbytes(8) for _ in range(60)]
    edges = [(nodes[i], nodes[i + 1]) for i in range(30)] + [(nodes[40], nodes[i]) for i in range(41, 55)]
    out = N.components(Scratch(spark, "t"), spark.createDataFrame(edges, "a binary, b binary")).collect()
    labels = {bytes(r.node): bytes(r.label) for r in out}
    assert len(labels) == 46
    assert len({labels[n] for n in nodes[:31]}) == 1
    assert len({labels[n] for n in nodes[40:55]}) == 1
    assert labels[nodes[0]] != labels[nodes[40]]


def test_signatures_estimate_the_overlap():
    rng = np.random.default_rng(3)
    est = []
    for _ in range(200):
        x = rng.integers(0, 2**63, 100).astype(np.uint64)
        sig = signatures(np.concatenate([x[:80], x[20:]]), np.array([0, 80, 160]), 128)
        est.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(est) - 0.6) < 0.01
    assert np.std(est) < 0.0433  # of independent minima
    assert band_hashes(sig, 4).shape == (2, 32)


def _shuffled(sets, slots, rng):
    """SuperMinHash with a random permutation for every element."""
    ranks = {}
    out = np.full((len(sets), slots), np.inf)
    for i, own in enumerate(sets):
        for x in own:
            if x not in ranks:
                ranks[x] = rng.permutation(slots) + rng.random(slots)
            out[i] = np.minimum(out[i], ranks[x])
    return out


@pytest.mark.parametrize(("n", "both"), [(4, 3), (40, 24), (300, 200)])
def test_variance_is_that_of_shuffled_tables(n, both):
    rng = np.random.default_rng(n)
    ours, true = [], []
    for _ in range(300):
        x = rng.integers(0, 2**63, 2 * n - both).astype(np.uint64)
        a, b = x[:n], x[n - both :]
        sig = signatures(np.concatenate([a, b]), np.array([0, n, 2 * n]), 128)
        ours.append((sig[0] == sig[1]).mean())
        sig = _shuffled([a, b], 128, rng)
        true.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(ours) - both / (2 * n - both)) < 0.01
    assert np.std(ours) < 1.2 * np.std(true) + 0.002
