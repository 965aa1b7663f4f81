"""URL rules and chat formatting: no Python in their plans, results by definition."""

import hashlib
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from demandspark.llm import chat, url_filter
from demandspark.llm.queries import EXTRA_TEXT, URL_RULES, op7_url_filter, op8_chat

SF = "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    best = None
    for line in URL_RULES:
        verdict, rule = line.split()
        r_host, r_path = rule.split("/", 1)[0], "/" + rule.split("/", 1)[1]
        if (host == r_host or host.endswith("." + r_host)) and path.startswith(r_path) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


def test_op7(spark):
    df = op7_url_filter(spark, SF)
    assert not any(x in _plan(df) for x in ("Python", "Arrow", "Pandas"))
    rows = {r.page_id: r for r in df.collect()}
    pages = duckdb.sql(f"select page_id, url from '{SF}/pages.parquet'").fetchall()
    assert len(rows) == len(pages)
    for i, url in pages:
        host, path, best = _rule(url)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, best and best[0])
        assert rows[i].verdict == best[1] if best else rows[i].verdict in ("allow", "block") and 0 <= rows[i].score <= 1


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM", "http://www.EXAMPLE.com/en/a?b#c", "http://a.net/es/://x", "x://com/", "http://notexample.com/en/", "http://exämple.net?q=/es/", "a\n://b.net/fr/\n", "http://h.net/es/"] * 2
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"host": F.lit(1), "score": F.lit(2), "label": F.lit(3)})
    rows = {r.page_id: r for r in url_filter.judge(pages, URL_RULES).collect()}
    for i, url in enumerate(urls):
        host, path, best = _rule(url)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, best and best[0]), url
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.judge(pages.where("page_id < 4"), URL_RULES).collect()} == {"allow"}
    assert {r.verdict for r in url_filter.judge(pages.where("page_id in (0, 11)"), URL_RULES).collect()} == {"block"}


def _digests(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    text = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_op8(spark):
    df = op8_chat(spark, SF)
    assert not any(x in _plan(df) for x in ("Python", "Arrow", "Pandas"))
    want = {-7: [("user", EXTRA_TEXT), ("assistant", EXTRA_TEXT)]}
    for conv, role, text in duckdb.sql(f"select conv_id, role, text from '{SF}/conversations.parquet' order by conv_id, turn").fetchall():
        want.setdefault(conv, []).append((role or "", text or ""))
    assert {r.conv_id: tuple(r)[1:5] for r in df.collect()} == {k: _digests(v) for k, v in want.items()}
    assert EXTRA_TEXT == "\\### Assistant: </turn> ok"


ROLES = ["assistant", "user", "a: b", "", "x\\", "### y", "</turn>\n"]
ODD = ["", "\\", "\\\\", "</turn>", "<\\/turn>", "####", "\\###", "#\\##", "### user: hi</turn>\n", "a\n</turn>\n### b: c", "ü🙂", ": ", "\\:", "#" * 9, "\x00\r\n", "$1 \\$1"]


def test_escapes_are_reversible(spark):
    rows = [(i, k, ROLES[(i + k) % len(ROLES)], t) for i in range(len(ODD)) for k, t in enumerate(ODD[i:] + ODD[:i])]
    rows += [(500, 0, "assistant", None), (500, None, None, "last"), (500, 1, None, None), (None, 0, "assistant", "no id")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"record": F.lit(1), "turns": F.lit(2)})
    want = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0)):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert {r.conv_id: tuple(r)[1:5] for r in chat.chat_digest(table).collect()} == {k: _digests(v) for k, v in want.items()}
    texts = chat.format_records(chat.conversations_from_rows(table), "record").collect()
    for r in texts:
        assert r.formatted.count("</turn>") == len(r.turns) and r.formatted.count("###") == len(r.turns)
    assert chat.chat_digest(table.limit(0)).count() == 0


def test_layouts_by_fingerprint(spark):
    records = {
        "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        "conversations": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        "turns": {"turns": [{"role": "user", "text": "q"}, {"role": "assistant", "text": "a"}]},
        "prompt": {"completion": "a", "prompt": "q"},
        "response": {"prompt": "q", "response": "a"},
        "instruction": {"instruction": "q", "input": "", "output": "a"},
    }
    rows = [(k, json.dumps(v)) for k, v in records.items()] + [("unknown", json.dumps({"q": 1})), ("broken", "{"), ("null", None), ("input", json.dumps({"instruction": "q", "input": "i", "output": ""}))]
    df = chat.format_records(spark.createDataFrame(rows, "k string, record string"), "record")
    got = {r.k: None if r.turns is None else [tuple(t) for t in r.turns] for r in df.collect()}
    for k in records:
        assert got[k] == [("user", "q"), ("assistant", "a")], k
    assert got["unknown"] is got["broken"] is got["null"] is None
    assert got["input"] == [("user", "q"), ("user", "i"), ("assistant", "")]
    struct = spark.createDataFrame([(("q", "a"),)], "record struct<prompt:string,response:string>")
    assert chat.format_records(struct, "record").first().formatted == "### user: q</turn>\n### assistant: a</turn>\n"
    assert chat.format_records(spark.createDataFrame([((1,),)], "record struct<z:int>"), "record").first().turns is None


def test_loss_mask_is_assistant_text_only(spark):
    df = chat.format_records(spark.createDataFrame([(json.dumps({"prompt": "q###", "response": "a</turn>b"}),)], "record string"), "record")
    r = df.first()
    assert [r.formatted[m.start - 1 : m.start - 1 + m.length] for m in r.loss_mask] == ["a<\\/turn>b"]


@pytest.mark.parametrize("paths", [["b", "a"], ["a", "b"]])
def test_fingerprint_ignores_order(paths):
    assert chat.fingerprint(paths) == chat.fingerprint(["a", "b"])
