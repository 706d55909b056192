"""Conversation repair, the joined embeddings and the Merkle manifest: against SQL, brute force, and odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpline.llm import conversation_repair, ego_join, merkle, queries, repair_paths
from tests.compare import duck, rows_of, sql_rows

SF = "/root/testdata/sf0.001"
CONV = "conv_id bigint, turn bigint, role string, text string, block string, at string"


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_ego_join", "op13_merkle_manifest"])
def test_query_equals_its_sql(spark, name):
    assert rows_of(queries.queries()[name](spark, SF)) == sql_rows(duck(SF), queries.oracle_sql()[name])


# -- op11


def _least(codes: bytes, longest: int) -> tuple[int, str]:
    """All sequences of edits, by breadth: the cheapest, and of these the least in ASCII."""
    best = None
    todo = [(0, 0, 0, "")]
    while todo:
        i, s, cost, letters = todo.pop()
        if best is not None and cost > best[0] or len(letters) > longest:
            continue
        if i == len(codes) and s in (0, 3):
            best = min(best or (cost, letters), (cost, letters))
        state = {0: "", 1: "s", 2: "u", 3: "a"}[s]
        wanted = "a" if state == "u" else "u"
        to = {"u": 2, "a": 3}[wanted]
        todo.append((i, to, cost + 3, letters + "I"))
        if i < len(codes):
            role, late, doomed = "sua?"[codes[i] % 4], 3 * (4 <= codes[i] < 8), codes[i] >= 8
            todo.append((i + 1, s, cost + 4, letters + "D"))
            if not doomed:
                todo.append((i + 1, to, cost + 3 + late, letters + "R"))
                if role == wanted:
                    todo.append((i + 1, to, cost + late, letters + "K"))
                if role == "s" and s == 0:
                    todo.append((i + 1, 1, cost + late, letters + "K"))
    return best


def test_paths_against_all_sequences_of_edits():
    rng = random.Random(1)
    some = [bytes(c) for n in range(3) for c in itertools.product(range(9), repeat=n)] + [bytes(rng.choices(range(9), k=rng.choice([3, 4]))) for _ in range(150)]
    for codes in some:
        letters, end = repair_paths.walk(codes, 0, repair_paths.GOAL, True)
        assert (repair_paths.cost_of(letters, codes), letters) == _least(codes, 2 * len(codes) + 2) and end in (0, 3)


def test_matrices_of_parts_give_the_matrix_of_the_whole():
    rng = random.Random(2)
    for _ in range(50):
        a, b = (bytes(rng.choices(range(12), k=rng.randrange(1, 6))) for _ in range(2))
        assert repair_paths.combined(repair_paths.matrix(a), repair_paths.matrix(b)) == repair_paths.matrix(a + b)
        assert repair_paths.before(repair_paths.matrix(a), repair_paths.GOAL) == tuple(repair_paths.distances(a, repair_paths.GOAL)[0])


def _by_hand(rows: list[tuple]) -> dict:
    out = {}
    for conv in {r[0] for r in rows}:
        kept = sorted((r[1:4] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] if r[1] is not None else " ", r[2] if r[2] is not None else " "))
        kept = [(t, " " if role is None else role, " " if text is None else text) for t, role, text in kept]
        faults, seen, codes = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in kept:
            bare = text.strip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            codes.append({"blank": 8, "duplicate": 8, "truncated": 4, None: 0}[fault] + ("sua".index(role[0]) if role[:1] in ("s", "u", "a") else 3))
        letters, _ = repair_paths.walk(bytes(codes), 0, repair_paths.GOAL, True)
        lines, i, last = [], 0, ""
        for x in letters:
            other = "assistant" if last == "u" else "user"
            if x == "I":
                lines.append(f"{other}:")
            elif x == "R":
                lines.append(f"{other}:{kept[i][2]}")
            elif x == "K":
                lines.append(f"{kept[i][1]}:{kept[i][2]}")
            last = last if x == "D" else lines[-1][0]
            i += x != "I"
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        out[conv] = (gaps, *faults.values(), illegal, repair_paths.cost_of(letters, bytes(codes)), letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def _conversations() -> list[tuple]:
    rng = random.Random(3)
    texts = ["One.", "Two!", "Three?", "cut", " \t", "", None, "x" * 50_000 + ".", "Ω ends.\n", "a\nb."]
    rows = [(c, rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), rng.choice(texts), "b", "a") for c in (None, 1, 2, 3) for _ in range(9)]
    rows += [(7, t, ("user", "assistant")[t % 2] if t % 11 else "system", "again." if t % 5 == 0 else f"turn {t}{'.' if t % 3 else ''}", "b", "a") for t in range(150)]  # spans blocks
    return rows + rows[:3] + [(9, None, None, None, None, None)]


@pytest.mark.parametrize("bits", [(10, 10), (2, 1), (3, 2)])
def test_conversations_inside_and_across_blocks(spark, bits):
    rows = _conversations()
    found = conversation_repair.repair(spark.createDataFrame(rows, CONV).repartition(3), *bits).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == _by_hand(rows) and len(found) == len({r[0] for r in rows})


@pytest.mark.parametrize("bits", [(10, 10), (2, 1)])
def test_edits_spell_the_audit_and_the_repaired_text(spark, bits):
    df = spark.createDataFrame(_conversations(), CONV)
    audits = {r.conv_id: (r.audit, r.repaired_sha256) for r in conversation_repair.repair(df).collect()}
    found: dict = {c: [] for c in audits}
    for r in sorted(conversation_repair.edits(df, *bits).collect(), key=lambda r: (r.block, r.k)):
        found[r.conv_id].append(r)
    assert {c: ("".join(r.letter for r in e), hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in e if r.letter != "D").encode()).hexdigest()) for c, e in found.items()} == audits


def test_damage_by_checksum_and_conversations_without_rows(spark):
    ids = [i for i in range(200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0][:2]  # both lose their only row
    df = spark.createDataFrame([(i, 0, "user", "Hi.", "", "") for i in ids], CONV)
    out = conversation_repair.repair(conversation_repair.damaged(df)).collect()
    assert sorted(tuple(r) for r in out) == [(i, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for i in ids]
    rows = conversation_repair.damaged(spark.range(400).select(F.col("id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("system").alias("role"), F.lit("A. B!").alias("text"))).collect()
    for conv in range(400):
        k, own = zlib.crc32(f"{conv}:1".encode()) % 20, [r for r in rows if r.conv_id == conv]
        assert len(own) == 1 + (k == 3) and own[0].gone == (k == 0) and own[0].role == ("user" if k == 4 else "system") and own[0].text == {1: "", 2: "A B"}.get(k, "A. B!")


def test_empty_conversations(spark):
    df = spark.createDataFrame([], CONV)
    assert conversation_repair.repair(conversation_repair.damaged(df)).count() == 0 == conversation_repair.edits(df).count()


# -- op12


def _links(rows: list[tuple], threshold: float) -> list[tuple]:
    """Counts and least ids from all pairs in double precision."""
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if k else None for (_, v), k in zip(rows, ok)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    n, root = [0] * len(rows), list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold:
            n[i], n[j] = n[i] + 1, n[j] + 1
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
    least = {}
    for (vec_id, _), r in zip(rows, root):
        least[r] = min(least.get(r, (True, 0)), (vec_id is None, vec_id or 0))
    out = []
    for (vec_id, _), c, r in zip(rows, n, root):
        component = None if least[r][0] else least[r][1]
        out.append((vec_id, c, component, vec_id == component))
    return out


def _vectors(dim: int, n: int, kind=np.float32) -> list[tuple]:
    rng = np.random.default_rng(dim)
    x = rng.standard_normal((n, dim)) * (0.9 ** np.arange(dim))
    x[n // 4 : n // 2] = x[n // 4] + 0.02 * rng.standard_normal((n // 2 - n // 4, dim)) * np.linalg.norm(x[n // 4]) / np.sqrt(dim)  # a tight group
    near = x[: n // 4] + 0.3 * rng.standard_normal((n // 4, dim)) * np.linalg.norm(x[: n // 4], axis=1)[:, None] / np.sqrt(dim)  # about the threshold
    x = np.vstack([x, near, x[:5], 7 * x[5:9], x[:5]]).astype(kind)
    return [(int(i), row.tolist()) for i, row in enumerate(x)]


def _order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("bytes_", [ego_join.SEGMENT_BYTES, 2000])
@pytest.mark.parametrize("element", ["float", "double"])
def test_links_against_all_pairs(spark, bytes_, element):
    rows = _vectors(16, 300, np.float32 if element == "float" else np.float64)
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [1.0, None] + [0.0] * 14), (1004, [float("nan")] + [1.0] * 15), (1005, [float("inf")] + [1.0] * 15)]
    rows += [(None, rows[0][1]), (None, [-x for x in rows[0][1]]), (5, rows[9][1]), (2000, [1.0, 2.0]), (2001, [2.0, 4.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id bigint, embedding array<{element}>, key string, seg int").repartition(5)
    assert _order(ego_join.linked(df, segment_bytes=bytes_).collect()) == _order(_links(rows, 0.95))


def test_intervals_that_are_wholly_linked_or_apart_need_no_vectors(spark):
    rng = np.random.default_rng(5)
    centres = np.eye(8)[:3]
    rows = [(int(i), (centres[i % 3] + 0.001 * rng.standard_normal(8)).tolist()) for i in range(240)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert _order(ego_join.linked(df, segment_bytes=8 * 8 * 10).collect()) == _order(_links(rows, 0.95))


def test_joined_skips_parts_and_still_counts_all():
    rng = np.random.default_rng(6)
    x = np.vstack([np.eye(6)[i] + 0.05 * rng.standard_normal((200, 6)) for i in range(3)])
    w = np.ones(len(x), np.int64)
    axes = np.eye(6)[:, :4]
    whole = ego_join._Sequence(x, w, axes)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert (ego_join.joined(whole, whole, 0.95, 8)[0] == want).all()
    a, b = ego_join._Sequence(x[:250], w[:250], axes), ego_join._Sequence(x[250:], w[250:], axes)
    both = np.concatenate(ego_join.joined(a, b, 0.95, 8)[:2])
    assert (both + np.concatenate([ego_join.joined(s, s, 0.95, 8)[0] for s in (a, b)]) == want).all()


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert ego_join.linked(df).count() == 0
    only = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id bigint, embedding array<float>")
    assert _order(ego_join.linked(only).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


# -- op13

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, root string"


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(leaves: list[str], fanout: int) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    paths = [[] for _ in leaves]
    level, of = leaves, [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, above_of = [], []
        for s in range(0, len(level), fanout):
            run = level[s : s + fanout]
            for k in range(len(run)):
                for leaf in of[s + k]:
                    paths[leaf].append((run[:k], run[k + 1 :]))
            above.append(_h(*run))
            above_of.append([x for o in of[s : s + fanout] for x in o])
        level, of = above, above_of
    return level[0], paths


def _manifest(rows: list[tuple], fanout: int) -> list[tuple]:
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda r, more=0: _h(*map(field, (r[0], r[3], r[2], r[4] + more if r[4] is not None else None, r[1])))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: _tree([leaf(r) for r in own[x]], fanout) for x in langs}
    root, tops = _tree([trees[x][0] for x in langs], fanout)
    out = []
    for x, top in zip(langs, tops):
        for r, path in zip(own[x], trees[x][1]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf(r, 1) if bad else leaf(r)
            for left, right in path + top:
                node = _h(*left, node, *right)
            out.append((r[0], leaf(r), trees[x][0], root, _h(*[s for a, b in path + top for s in a + b]), node, node == root))
    return out


@pytest.mark.parametrize(("fanout", "levels"), [(2, 10), (2, 1), (2, 2), (3, 2), (5, 1)])
def test_manifest_against_whole_trees(spark, fanout, levels):
    texts = [None, "", "é" * 20_000, "plain", "2:ab", "tie"]
    rows = [(i, texts[i % 6], ["en", "de", None, "é", "", "zz"][min(i % 11, 5)], None if i % 4 == 0 else "s", None if i % 5 == 0 else i, "x", "y") for i in range(70)]
    rows += [(None, "no id", "en", "s", 3, "x", "y"), (3, "again", "é", "s", 1, "x", "y"), (200, "alone", "fr", "s", (1 << 63) - 1, "x", "y")]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    found = merkle.audited(df, fanout, levels).collect()
    assert sorted(map(tuple, found), key=key) == sorted(_manifest(rows, fanout), key=key)
    assert any(not r.verified for r in found)


def test_equal_rows_and_single_rows_and_none(spark):
    same = [(1, "t", "en", "s", 1, "", "")] * 5
    found = merkle.audited(spark.createDataFrame(same, DOCS)).collect()
    assert len(found) == 5 and all(r.verified for r in found) and sorted(map(tuple, found)) == sorted(_manifest(same, 2))
    (one,) = merkle.audited(spark.createDataFrame(same[:1], DOCS)).collect()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == _h()
    assert merkle.audited(spark.createDataFrame([], DOCS)).count() == 0
