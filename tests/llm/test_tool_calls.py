import json

import pytest
from pyspark.sql import functions as F

from runoff.llm import tool_calls as T
from runoff.llm.queries import QUERIES, SCHEMAS, conversation_calls
from tests.llm.helpers import SF

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, uses array<string>"


def brute(calls, results, schemas):
    """{call_id: (level, status, errors)} of calls with ids, and of lone results."""
    known, content = {}, {}
    for c in calls:
        if c[2] is not None:
            known[c[2]] = c
    for i, text in results:
        if i is not None and (i not in content or (text is not None and (content[i] is None or text < content[i]))):
            content[i] = text
    level, left = {}, dict(known)
    while True:
        free = [i for i, c in left.items() if all(u in level or u not in known for u in c[5] or [] if u is not None)]
        free = [i for i in free]
        if not free:
            break
        for i in free:
            used = [level[u] for u in known[i][5] or [] if u in known]
            level[i] = 1 + max(used) if used else 0
            del left[i]
    out = {}
    kinds = {"string": str, "integer": int, "array": list, "boolean": bool, "object": dict}
    for i, c in known.items():
        errors, schema = [], schemas.get(c[3])
        try:
            value = json.loads(c[4])
        except (TypeError, ValueError):
            value = None
        if schema is None:
            errors = [f"unknown tool: {c[3] or 'null'}"]
        elif not isinstance(value, dict):
            errors = ["arguments are no JSON object"]
        else:
            for p, (kind, required) in schema.items():
                if value.get(p) is None:
                    errors += [f"{p}: missing"] * required
                elif type(value[p]) is not kinds[kind]:
                    errors.append(f"{p}: not {kind}")
            errors += [f"{k}: unknown" for k in value if k not in schema]
        errors = sorted(errors) + sorted({f"uses unknown call: {u}" for u in c[5] or [] if u is not None and u not in known})
        status = ("cycle" if i not in level else "invalid" if errors else "no_result" if i not in content else "ok")
        out[i] = (level.get(i), status, errors)
    return out | {i: (None, "no_call", []) for i in content if i not in known}


def test_linking_order_and_validation(spark):
    calls = [(1, 0, "a", "search", '{"query":"x","limit":3}', []),
             (1, 1, "b", "search", '{"limit":"3","more":1}', ["a", "a", None]),
             (1, 2, "c", "translate", '{"text":"é","to":null}', ["b", "gone"]),
             (1, 3, "d", "count", '{"words":[1,{"z":1,"a":[]}]}', ["a", "b"]),
             (2, 0, "e", "count", "[1]", None), (2, 1, "f", "count", "not json", ["f"]),
             (2, 2, "g", None, None, ["f"]), (2, 3, "h", "nope", "{}", ["a"]),
             (3, 0, "i", "search", '{"query":"q","limit":1.5}', ["j"]), (3, 1, "j", "search", '{"query":"q","limit":1}', ["i"]),
             (3, 2, None, "search", "{}", []), (None, None, "k", "count", '{"words":[]}', ["d"])]
    results = [("a", "r1"), ("a", "r0"), ("b", None), ("zz", "lone"), (None, "none"), ("c", "done"), ("k", "")]
    df = spark.createDataFrame(calls, CALLS).selectExpr("*", "1 AS call", "2 AS level", "'x' AS result")
    out = T.format_calls(df, spark.createDataFrame(results, "call_id string, content string"), SCHEMAS)
    assert out.columns == ["conv_id", "turn", "call_id", "level", "status", "errors", "json"]
    rows = out.collect()
    got = {r.call_id: (r.level, r.status, r.errors) for r in rows if r.call_id is not None}
    assert got == brute(calls, results, SCHEMAS) and len(rows) == len(got) + 2
    assert sorted(r.status for r in rows if r.call_id is None) == ["no_call", "no_id"]
    by = {r.call_id: r.json for r in rows}
    for text in by.values():
        value = json.loads(text)
        assert text == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert sorted(value) == ["arguments", "errors", "id", "level", "name", "result", "status", "uses"]
    assert json.loads(by["a"])["result"] == "r0" and json.loads(by["d"])["arguments"] == {"words": [1, {"z": 1, "a": []}]}
    assert json.loads(by["f"])["arguments"] == "not json" and json.loads(by["g"])["arguments"] is None


def test_repeated_calls_long_chains_and_empty_tables(spark):
    chain = [(1, i, f"c{i}", "count", '{"words":[]}', [f"c{i - 1}"] if i else []) for i in range(6)] * 2
    none = spark.createDataFrame([], "call_id string, content string")
    rows = T.format_calls(spark.createDataFrame(chain, CALLS), none, SCHEMAS).collect()
    assert sorted((r.call_id, r.level) for r in rows) == [(f"c{i}", i) for i in range(6)]
    assert T.format_calls(spark.createDataFrame([], CALLS), none, SCHEMAS).collect() == []


def test_query_equals_brute_force(spark):
    calls, results = conversation_calls(spark.read.parquet(f"{SF}/conversations.parquet"))
    columns = ["conv_id", "turn", "call_id", "name", "arguments", "uses"]
    want = brute([tuple(r) for r in calls.select(*columns).collect()],
                 [tuple(r) for r in results.select("call_id", "content").collect()], SCHEMAS)
    rows = QUERIES["op5_tool_calls"](spark, SF).collect()
    known = [r for r in rows if r.call_id is not None]
    assert {r.call_id: (r.level, r.status, r.errors) for r in known} == want and len(known) == len(want)
    assert max(level for level, _, _ in want.values() if level is not None) >= 2
    # chains, one call a user's text and turn, and no use of a call that is not there
    turns = spark.read.parquet(f"{SF}/conversations.parquet").where("role = 'user'")
    assert sum(r.status != "no_call" for r in known) == turns.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.coalesce("text", F.lit(""))).distinct().count()
    assert not any("unknown call" in e for r in rows for e in r.errors)


def test_conversations_with_missing_and_repeated_turns(spark):
    said = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "A"), (1, 3, "user", "b"), (1, 3, "user", "c"),
            (1, 3, "user", "c"), (1, 4, "assistant", None), (1, 5, "user", None), (1, 8, "user", "next eight"), (2, 0, "assistant", "lone"),
            (None, 0, "user", "x"), (None, 0, "user", "x"), (1, None, "user", "y"), (1, None, "assistant", "z"), (3, 0, None, "?")]
    df = spark.createDataFrame(said, "conv_id long, turn int, role string, text string").selectExpr("*", "1 AS call_id", "2 AS used")
    calls, results = conversation_calls(df)
    rows = T.format_calls(calls, results, SCHEMAS).collect()
    by = {}
    for r in rows:
        by.setdefault((r.conv_id, r.turn, r.status), []).append(r)
    assert [len(by[k]) for k in ((None, 0, "no_id"), (1, None, "no_id"), (None, None, "no_call"))] == [2, 1, 2]
    linked = {r.call_id: r for r in rows if r.call_id is not None and r.status != "no_call"}
    assert sorted((r.turn, r.level) for r in linked.values()) == [(1, 0), (3, 1), (3, 1), (5, 2), (8, 0)]
    first = {t: min(i for i, r in linked.items() if r.turn == t) for t in (1, 3, 5)}
    uses = {i: json.loads(r.json)["uses"] for i, r in linked.items()}
    assert all(uses[i] == ([first[{3: 1, 5: 3}[r.turn]]] if r.turn in (3, 5) else []) for i, r in linked.items())
    assert json.loads(linked[first[1]].json)["result"] == "A"
    assert T.format_calls(*conversation_calls(df.limit(0)), SCHEMAS).isEmpty()


def test_no_python_in_the_plan(spark):
    df = QUERIES["op5_tool_calls"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
