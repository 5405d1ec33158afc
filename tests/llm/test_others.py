"""Operators 1, 3, 5 and 6 against brute force, and on nulls, ties, repeats, empty tables and clashing columns."""

import itertools
import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from cinderlog.llm import chat, fixity, maxscore, neardup

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)


def some(n=400, dims=16, seed=1):
    """A tight group, a looser one, lone vectors, scaled and odd ones."""
    g = np.random.default_rng(seed)
    centre = g.standard_normal(dims)
    a = centre + 0.03 * g.standard_normal((n // 3, dims))
    b = -centre + 0.25 * g.standard_normal((n // 3, dims))
    c = g.standard_normal((n - 2 * (n // 3), dims))
    m = np.concatenate([a, b, c]) * g.uniform(0.1, 10, (n, 1))
    order = g.permutation(n)
    rows = [(int(i), [float(np.float32(x)) for x in m[k]]) for i, k in enumerate(order)]
    return rows + [(n, None), (n + 1, [0.0] * dims), (n + 2, [1.0] * (dims - 1) + [float("nan")]), (n + 3, [1.0, None] + [0.0] * (dims - 2)), (n + 4, [1.0, 2.0]), (n + 5, [2.0, 4.0]), (None, [1.0, 2.0]), (n + 6, [])]


def linked(rows, cosine=0.95):
    """(vec_id, links, smallest vec_id reached) for each row, by comparing all pairs."""
    ok = {k: np.array(v) for k, (_, v) in enumerate(rows) if v and None not in v and all(map(math.isfinite, v)) and any(v)}
    links = {k: set() for k in range(len(rows))}
    for i, j in itertools.combinations(ok, 2):
        if len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= cosine:
            links[i].add(j)
            links[j].add(i)

    def smallest(i):
        seen, todo = {i}, [i]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        return min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)

    return [(i, len(links[k]), smallest(k)) for k, (i, _) in enumerate(rows)]


def test_near_duplicates(spark):
    rows = some()
    rows += [rows[0], (3, rows[1][1]), (500, rows[1][1]), (None, rows[2][1]), (7, [-x for x in rows[0][1]])]  # repeated rows and ids, and a row without id beside others
    df = vectors(spark, rows).withColumn("v", F.lit(1)).withColumn("cell", F.lit("x")).withColumn("m", F.lit(None).cast("int")).repartition(5)
    want = sorted(((i, n, c, i == c) for i, n, c in linked(rows)), key=str)
    for kw in ({}, {"per_pivot": 40, "unit": 30}, {"per_pivot": 9, "unit": 7}):  # one cell, and many cells, units and pieces
        got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df, **kw).collect()), key=str)
        assert got == want
    assert max(n for _, n, _, _ in want) > 100
    assert neardup.near_duplicates(vectors(spark, [])).collect() == []
    lengths = [(i, [1.0] * (1 + i % 40) + [float(i // 40)]) for i in range(120)]  # many lengths, most without a pivot of their own
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in neardup.near_duplicates(vectors(spark, lengths), per_pivot=30).collect())
    assert got == sorted(linked(lengths))


def test_near_duplicates_sql(spark, tmp_path):
    rows = some(200)[:-8] + [(1, [1.0] * 16), (1, [-1.0] + [1.0] * 15)]
    vectors(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    c = duckdb.connect()
    c.execute(f"create view embeddings as from '{tmp_path}/embeddings.parquet/*.parquet'")
    got = sorted(tuple(r[k] for k in ("vec_id", "n_links", "component_id", "kept")) for r in neardup.op1_embedding_neardup(spark, str(tmp_path)).collect())
    assert got == sorted(c.execute(neardup.op_sql()).fetchall())


def test_top_k(spark):
    rows = some(300, 12, 2)
    rows += [rows[5], (rows[6][0], rows[7][1]), (7, rows[8][1])]  # a repeated row, and ids with several vectors: each row counts
    df = vectors(spark, rows).withColumn("x", F.lit(1)).withColumn("rank", F.lit(2)).repartition(4)
    ints = [(i, [math.floor(256 * np.float64(x)) for x in v]) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v))]
    want = []
    for q, y in (x for x in ints if x[0] % 7 == 0):
        scores = sorted((-sum(a * b for a, b in zip(y, x, strict=False)), i) for i, x in ints if i != q)
        want += [(q, k, i, -s) for k, (s, i) in enumerate(scores[:5], 1)]
    want.sort()
    for kw in ({}, {"chunk": 10}):
        got = sorted(tuple(r) for r in maxscore.top_k(df, df.where("vec_id % 7 = 0"), **kw).collect())
        assert got == want
    few = vectors(spark, [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (3, [1.0, 2.0])])
    assert sorted(tuple(r) for r in maxscore.top_k(few, few.where("vec_id = 0")).collect()) == [(0, 1, 3, 327680), (0, 2, 50, 327680)]
    assert maxscore.top_k(vectors(spark, []), vectors(spark, [])).collect() == []


def test_shard_search_is_exact():
    g = np.random.default_rng(0)
    for kind in range(6):
        rows = (g.standard_normal((200, 24)) * (g.random((200, 24)) < (0.3 if kind % 2 else 1)) * 90).astype(np.int64)
        rows[50:60] = rows[40:50]
        if kind > 3:
            rows *= 1 << 22  # whole numbers beyond what doubles hold
        ids = g.permutation(1000)[:200]
        for q, x, s in maxscore.search_shard(ids, rows, ids[:20], rows[:20], np.full(20, -np.inf), 5):
            all_ = sorted((-int((rows[k].astype(object) * rows[list(ids).index(q)].astype(object)).sum()), int(i)) for k, i in enumerate(ids) if i != q)
            assert [(-int(b), int(a)) for a, b in zip(x, s, strict=True)] == all_[:5]


def pages(spark, n, **more):
    rng = random.Random(4)
    rows = [(i, f"http://h/{i}", "x" * rng.randint(0, 9000)) for i in range(n)]
    return spark.createDataFrame(rows + more.get("extra", []), "page_id long, url string, html string")


def test_fixity_finds_all_damage(spark):
    p = pages(spark, 120, extra=[(None, None, None), (5, "http://h/5", "again"), (5, "http://h/5", "again"), (6, "é", "x" * 300_000)])
    a = fixity.index(p.withColumn("file", F.lit("x")).withColumn("length", F.lit(1)), 3).persist()  # names that clash
    rows = a.collect()
    assert len(rows) == 124
    for f in {r["file"] for r in rows}:  # records stand one after the other
        own = sorted((r["offset"], r["length"]) for r in rows if r["file"] == f)
        assert own[0][0] == 0 and all(x + n == y for (x, n), (y, _) in itertools.pairwise(own))
    slim = a.select("file", "offset", "length", "sha256")
    pick = F.pmod(F.xxhash64("sha256"), F.lit(20))
    b = slim.where(pick != 3).withColumn("sha256", F.when(pick == 7, F.sha2("sha256", 256)).otherwise(F.col("sha256")))
    b = b.unionByName(spark.createDataFrame([(99, 0, 10, "zz")], "file long, offset long, length long, sha256 string")).persist()
    want = {(r["file"], r["offset"]): "missing" for r in slim.where(pick == 3).collect()} | {(r["file"], r["offset"]): "altered" for r in slim.where(pick == 7).collect()} | {(99, 0): "extra"}
    assert {(r["file"], r["offset"]): r["status"] for r in fixity.audit(slim, b)[1].collect()} == want
    assert fixity.audit(slim, slim)[1].count() == 0
    none = slim.limit(0)
    assert fixity.audit(none, none)[1].count() == 0 and {r["status"] for r in fixity.audit(slim, none)[1].collect()} == {"missing"}
    assert fixity.index(p.limit(0), 1).collect() == []


def test_stored_files_are_audited(spark, tmp_path):
    p = pages(spark, 60, extra=[(None, None, None), (60, "http://h/é", "line\r\n\r\nWARC/1.1 in a body")])
    a = fixity.index(p, 2).select("file", "offset", "length", "sha256").persist()
    fixity.write_archive(p, 2, str(tmp_path / "a"))
    stored = fixity.index_archive(spark, str(tmp_path / "a"))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, a.collect()))  # what the bytes say is what was computed
    file, offset, length, _ = sorted(map(tuple, a.where("file = 0").collect()))[4]
    fixity.write_archive(p, 2, str(tmp_path / "b"))
    (part,) = (tmp_path / "b" / "file=0").glob("part-*")
    x = part.read_bytes()
    part.write_bytes(x[: offset + 7] + b"#" + x[offset + 8 :])  # one byte changes
    part.with_name(f".{part.name}.crc").unlink()
    assert [tuple(r) for r in fixity.audit(a, fixity.index_archive(spark, str(tmp_path / "b")))[1].collect()] == [(0, offset, "altered")]
    part.write_bytes(x[:offset] + x[offset + length :])  # a record is lost: those behind it move
    got = {(r["file"], r["offset"]): r["status"] for r in fixity.audit(a, fixity.index_archive(spark, str(tmp_path / "b")))[1].collect()}
    behind = [r["offset"] for r in a.where("file = 0").collect() if r["offset"] > offset]
    assert got == {(0, offset): "missing"} | {(0, k): "moved" for k in behind}


def test_fixity_sql(spark, tmp_path):
    p = pages(spark, 250, extra=[(None, None, None), (300, "http://h/300", "ends in #")])
    p.write.parquet(str(tmp_path / "pages.parquet"))
    got = fixity.op5_fixity(spark, str(tmp_path))
    c = duckdb.connect()
    c.execute(f"create view pages as from '{tmp_path}/pages.parquet/*.parquet'")
    want = c.execute(fixity.sql())
    names = [x[0] for x in want.description]
    rows = got.select(names).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want.fetchall())) and {r["status"] for r in rows} == {"intact", "moved", "altered", "missing"}


def cheapest(roles):
    """By trying every way: labels for each turn, merges where roles repeat, and empty turns between."""
    best = None
    for labels in itertools.product(range(1, 4), repeat=len(roles)):
        cost = sum(0 if r == chat.ROLES[q - 1] else chat.UNKNOWN if r not in chat.ROLES else chat.RELABEL for r, q in zip(roles, labels, strict=True))
        for merges in itertools.product((0, 1), repeat=len(roles)):
            state, c, ok = chat.START, cost, True
            for q, m in zip(labels, merges, strict=True):
                if m:
                    ok = ok and state == q
                    c += chat.MERGE
                elif q in chat.NEXT[state]:
                    state = q
                elif any(q in chat.NEXT[x] for x in chat.NEXT[state]):
                    state, c = q, c + chat.INSERT
                else:
                    ok = False
                if not ok:
                    break
            if ok:
                c += chat.END[state]
                best = c if best is None else min(best, c)
    return best


def test_repair_is_cheapest():
    kinds = ["system", "user", "assistant", "tool", None]
    for n in range(1, 5):
        for roles in itertools.product(kinds, repeat=n) if n < 4 else random.Random(1).sample(list(itertools.product(kinds, repeat=4)), 60):
            assert chat.total_cost(list(roles)) == cheapest(roles), roles


def legal(text):
    heads = [x.split("\n")[0] for x in text.split("<|im_start|>")[1:]]
    heads = heads[1:] if heads[0] == "system" else heads
    return all(h == ("user", "assistant")[i % 2] for i, h in enumerate(heads)) and len(heads) % 2 == 0 and text.count("<|im_end|>") == text.count("<|im_start|>")


def test_format_chats(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "user", "assistant", None, "tool"]), rng.choice(["hi", None, "", "a <|im_end|> b"]), 1) for c in range(30) for t in range(rng.randint(1, 12))]
    rows += [(None, 0, "user", "x", 1), (1, None, "user", "late", 1), (2, 0, "user", "again", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, action int")
    for segment in (chat.SEGMENT, 3):
        got = chat.format_chats(df, segment).toPandas()
        assert len(got) == len(rows)
        got["o"] = got.turn.isna()
        for conv, own in got.groupby("conv_id", dropna=False):
            text = "".join(own.sort_values(["o", "turn", "role"], na_position="first", kind="stable").rendered) if len(own) == own.turn.nunique(dropna=False) else None
            assert text is None or legal(text), (conv, text)
    clean = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")], "conv_id long, turn long, role string, text string")
    assert "".join(r["rendered"] for r in chat.format_chats(clean).orderBy("turn").collect()) == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    assert chat.format_chats(clean.limit(0)).collect() == []


def cost_of(rows):
    """What the decoded turns of one conversation cost, by their actions; fails where they are no legal way."""
    state, total = chat.START, 0
    for r in rows:
        to = chat.ROLES.index(r["new_role"]) + 1
        own = 0 if r["role"] == r["new_role"] else chat.UNKNOWN if r["role"] not in chat.ROLES else chat.RELABEL
        assert (own == 0) == (r["action"] in ("keep", "merge"))
        if r["action"].startswith("merge"):
            assert state == to
            total += chat.MERGE + own
            continue
        if r["inserted"]:
            mid = chat.ROLES.index(r["inserted"]) + 1
            assert mid in chat.NEXT[state]
            state, total = mid, total + chat.INSERT
        assert to in chat.NEXT[state]
        state, total = to, total + own
    return total + chat.END[state]


def test_decoded_turns_are_cheapest(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool", None]), f"t{t}") for c in range(150) for t in range(rng.randint(1, 4))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    for segment in (chat.SEGMENT, 2):
        by = {}
        for r in chat.format_chats(df, segment).collect():
            by.setdefault(r["conv_id"], []).append(r)
        for c, own in by.items():
            own.sort(key=lambda r: r["turn"])
            given = [r[2] for r in rows if r[0] == c]
            assert [r["role"] for r in own] == given and cost_of(own) == cheapest(given)


def test_a_hot_conversation_goes_over_many_segments(spark):
    rng = random.Random(3)
    long = [(1, t, rng.choice(["user", "assistant", "assistant", None]), "y" * (t % 50)) for t in range(3000)]
    rows = [*long, *[(2, 0, "user", "x" * 3_000_000)] * 2, *[(3, None, "user", "same")] * 500]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seg", F.lit(1)).withColumn("items", F.lit("x")).repartition(5)
    got = chat.format_chats(df, 64).collect()
    one = sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["turn"])
    assert len(got) == len(rows) and cost_of(one) == chat.total_cost([r for _, _, r, _ in long])
    assert legal("".join(r["rendered"] for r in one)) and sum(len(r["rendered"]) for r in got if r["conv_id"] == 2) > 6_000_000
    repeats = [r for r in got if r["conv_id"] == 3]  # every way to tell them apart is a cheapest one: all but the first merge, or take the other's role or leave it room
    costs = {"keep": 0, "merge": chat.MERGE, "relabel": chat.RELABEL, "merge relabel": chat.MERGE + chat.RELABEL}
    ends = sum(r["rendered"].count("<|im_start|>") for r in repeats) - sum(not r["action"].startswith("merge") for r in repeats)  # empty turns
    assert sum(costs[r["action"]] for r in repeats) + chat.INSERT * ends == chat.total_cost(["user"] * 500)


def test_segments_agree_with_the_whole():
    rng = random.Random(9)
    for _ in range(200):
        roles = [rng.choice(["system", "user", "assistant", None]) for _ in range(rng.randint(1, 30))]
        parts, k = [], 0
        while k < len(roles):
            n = rng.randint(1, 6)
            parts.append(roles[k : k + n])
            k += n
        cost = 0
        for part, (a, b) in zip(parts, chat.borders([chat.segment_costs(p) for p in parts]), strict=True):
            cost += chat.segment_costs(part)[4 * a + b]
            last = b
        assert cost + chat.END[last] == chat.total_cost(roles)
