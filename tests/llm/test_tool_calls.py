import json

from ledgerline.llm import tool_calls as T

MESSAGES = f"conv long, turn long, role string, text string, tool_calls {T.CALLS}, tool_call_id string"
SCHEMA = {"find": {"type": "object", "required": ["q"], "additionalProperties": False, "properties": {
    "q": {"type": "string", "minLength": 1, "pattern": "^[a-z ]+$"}, "n": {"type": "integer", "minimum": 1, "maximum": 9},
    "kinds": {"type": "array", "items": {"enum": ["a", "b"]}}}}}


def call(i, arguments='{"q":"x"}', after=(), name="find"):
    return (i, name, arguments, list(after))


def run(spark, rows):
    return T.linked(spark.createDataFrame(rows, MESSAGES).selectExpr("*", "1 AS id", "2 AS row", "3 AS kind"), SCHEMA).collect()


def test_links_order_and_status(spark):
    rows = [(1, 0, "user", "hi", None, None),
            (1, 1, "assistant", None, [call("c"), call("a", after=["b"]), call("b")], None),
            (1, 2, "tool", "ra", None, "a"), (1, 3, "tool", "rb", None, "b"), (1, 4, "tool", "rc", None, "c"),
            (1, 5, "tool", "again", None, "c"), (1, 6, "tool", "?", None, "zz"), (1, 7, "assistant", None, [call("c")], None),
            (1, 8, "assistant", None, [call("u"), call(None), call("x", after=["y"]), call("y", after=["x"]), call("z", after=["nowhere"])], None),
            (2, 0, "tool", "early", None, "a"), (2, 1, "assistant", None, [call("a")], None),
            (None, None, None, None, None, None), (None, None, None, None, None, None)]
    got = run(spark, rows)
    at = {(r["conv"], r["kind"], r["id"], r["turn"]): r for r in got}
    status = {k: r["status"] for k, r in at.items()}
    assert status[1, "call", "a", 1] == status[1, "result", "a", 2] == "linked" and status[1, "message", None, 0] == "message"
    assert status[1, "result", "c", 5] == status[1, "call", "c", 7] == "duplicate" and status[1, "result", "zz", 6] == "orphan"
    assert status[1, "call", "u", 8] == "unanswered" == status[1, "call", "z", 8] and status[1, "call", None, 8] == "no_id"
    assert status[1, "call", "x", 8] == status[1, "call", "y", 8] == "cyclic"
    for conv in (1, 2, None):
        mine = [r for r in got if r["conv"] == conv]
        assert sorted(r["order_no"] for r in mine) == list(range(1, len(mine) + 1))
    n = {k: r["order_no"] for k, r in at.items()}
    assert n[1, "call", "b", 1] < n[1, "result", "b", 3] < n[1, "call", "a", 1] < n[1, "result", "a", 2]
    assert n[2, "call", "a", 1] < n[2, "result", "a", 0]


def test_a_long_chain(spark):
    k = 12
    rows = [(1, 0, "assistant", None, [call(str(i), after=[str(i + 1)] if i < k else []) for i in range(k + 1)], None)]
    rows += [(1, i + 1, "tool", "r", None, str(i)) for i in range(k + 1)]
    n = {(r["kind"], r["id"]): r["order_no"] for r in run(spark, rows)}
    assert all(n["result", str(i + 1)] < n["call", str(i)] < n["result", str(i)] for i in range(k))


def test_a_call_that_waits_for_several_levels(spark):
    after = {"a": ["b", "d", "c"], "b": ["c", "c"], "c": ["d"], "d": [], "e": ["d", "a"], "f": ["f", "d"]}
    rows = [(1, 0, "assistant", None, [call(i, after=x) for i, x in after.items()], None)]
    rows += [(1, t + 1, "tool", "r", None, i) for t, i in enumerate(after)]
    got = {(r["kind"], r["id"]): r for r in run(spark, rows)}
    assert {i: got["call", i]["level"] for i in "abcde"} == {"d": 0, "c": 2, "b": 4, "a": 6, "e": 8}
    assert got["call", "f"]["status"] == "cyclic"
    for i in "abcde":
        assert all(got["result", x]["order_no"] < got["call", i]["order_no"] for x in after[i])


def test_arguments_and_canonical_json(spark):
    cases = {'{"n":3,"q":"ab c"}': None, '{"q": "é", "n": 2.0}': "$.q: pattern", '{"q":""}': "$.q: length; $.q: pattern", "{}": "$.q: required",
             '{"q":"a","n":10,"z":1}': "$.z: unknown; $.n: range", '{"q":"a","n":true}': "$.n: type", '{"q":"a","kinds":["a","c"]}': "$.kinds[1]: enum",
             "[1]": "$: type", "{": "$: not JSON", '{"q":NaN}': "$: not JSON"}
    rows = [(1, i, "assistant", None, [call(str(i), a)], None) for i, a in enumerate(cases)] + [(1, 99, "assistant", None, [call("t", name="other"), call("n", None)], None)]
    got = {r["id"]: r for r in run(spark, rows)}
    for i, (a, fault) in enumerate(cases.items()):
        r = got[str(i)]
        assert (r["args_valid"], r["faults"]) == (fault is None, fault)
        if fault != "$: not JSON":
            assert json.loads(r["json"])["arguments"] == json.loads(a)
    assert got["0"]["json"] == '{"arguments":{"n":3,"q":"ab c"},"id":"0","name":"find","type":"call"}'
    assert got["1"]["json"].startswith('{"arguments":{"n":2.0,"q":"é"}')
    assert got["t"]["faults"] == "$: unknown tool" and got["n"]["faults"] == "$: not JSON"


def test_empty_and_given_conversations(spark, sf_dir):
    assert run(spark, []) == []
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = T.linked(T.as_tool_messages(c), T.SCHEMAS).collect()
    assert len(got) == c.count()
    seen = {(r["conv_id"], r["turn"], r["role"]) for r in c.collect()}
    for r in got:
        if r["kind"] == "call":
            assert (r["status"] == "linked") == ((r["conv"], r["turn"] + 1, "assistant") in seen)
            assert json.loads(r["json"])["arguments"]["turn"] == r["turn"]


def test_a_lone_surrogate_in_arguments_stays_an_escape():
    """JSON may name half of a pair; no UTF-8 text can hold it."""
    import json
    for text in ('{"query":"\\ud800","turn":0}', '{"\\udfff":"x","query":"\\ud83d\\ude00"}'):
        out, _, wrong = T._event("call", "1", "search", text, None, None, T.SCHEMAS)
        out.encode(), (wrong or "").encode()
        assert json.loads(out)["arguments"] == json.loads(text)
