import hashlib
import random

from tidemark.llm import chat

SCHEMA = "tree string, node long, parent long, role string, text string, score double"


def test_escapes_are_reversible(spark):
    rng = random.Random(4)
    parts = ["\\", "\\s", "\\o", "### ", "#", " ", "</turn>", "</turn", ">\n", "\n", ":", ":\n", "é😀", "a", "### assistant:\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    roles = ["user", "assistant", "a:\nb\\n", "</turn>\n### user:\n"]
    rows = [("t", k, k - 1 if k else None, roles[k % 4], t, 0.0) for k, t in enumerate(texts)]
    got = chat.parsed(chat.formatted(spark.createDataFrame(rows, SCHEMA))).orderBy("pos").collect()
    assert [(r.role, r.text, r.learnt) for r in got] == [(r[3], r[4], r[4] if r[3] == "assistant" else "") for r in rows]


def brute_best(rows, top):
    by = {(t, n): (p, s or 0.0) for t, n, p, _, _, s in rows}
    parents = {(t, p) for t, _, p, *_ in rows}
    found = {}
    for t, n in by:
        if (t, n) in parents:
            continue
        path, at, seen = [], n, set()
        while at is not None and (t, at) in by and at not in seen:
            seen.add(at)
            path.append(at)
            at = by[t, at][0]
        if at in seen:
            continue
        found.setdefault(t, []).append((-sum(by[t, x][1] for x in path) / len(path), -len(path), n, path[::-1]))
    return {(t, p[2]): p[3] for t, ps in found.items() for p in sorted(ps)[:top]}


def test_paths_equal_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for tree in range(30):
        for n in range(rng.randint(1, 40)):
            parent = rng.choice([None, *range(n), *range(n)]) if n else None
            rows.append((f"t{tree}", n, parent, "user", "x", rng.choice([None, 0.5, 0.25, 1.0])))
    rows += [("chain", n, n - 1 if n else None, "user", "x", 0.0) for n in range(300)]
    rows += [("cycle", 1, 2, "user", "x", 0.0), ("cycle", 2, 1, "user", "x", 0.0), ("lost", 5, 77, "user", "x", 0.0)]
    nodes = spark.createDataFrame(rows, SCHEMA)
    for top in (1, 3):
        got = {}
        for r in chat.best_paths(nodes, top).collect():
            got.setdefault((r.tree, r.path), []).append((r.pos, r.node))
        assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == brute_best(rows, top)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_brute_force(spark, data):
    by = {}
    for r in spark.read.parquet(f"{data}/conversations.parquet").collect():
        by.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    hard = "\\### Assistant: </turn> ok"
    by[-7] = [(0, "user", hard), (1, "assistant", hard)]
    got = {r.conv_id: r for r in chat.op3_reply_trees(spark, data).collect()}
    assert got.keys() == by.keys()
    for k, turns in by.items():
        turns.sort()
        learnt = "".join(t for _, role, t in turns if role == "assistant")
        r = got[k]
        assert (r.n_turns, r.turns_sha256) == (len(turns), digest("".join(f"{role}\n{t}\n" for _, role, t in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), digest(learnt))
        assert r.formatted_chars > sum(len(t) for *_, t in turns)


def test_nulls_ties_and_empty_tables(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"), (None, 2, "assistant", "no id"), (2, 5, "assistant", "x" * 200_000)]
    messages = chat.chains(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.tree: r for r in chat.formatted(messages).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {"1": 3, "null": 1, "2": 1}
    assert got["1"].formatted == "### :\nfirst</turn>\n### user:\n</turn>\n### user:\n</turn>\n"
    assert got["2"].mask[0].length == 200_000
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_extra_columns_do_not_clash(spark):
    rows = [("t", 1, None, "user", "q", 0.0, 9, 9, 9), ("t", 2, 1, "assistant", "a", 0.0, 9, 9, 9)]
    df = spark.createDataFrame(rows, SCHEMA + ", path long, pos long, steps long")
    assert chat.formatted(df).first().formatted == "### user:\nq</turn>\n### assistant:\na</turn>\n"


def test_main_path_is_native(spark, data):
    plan = chat.op3_reply_trees(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))
