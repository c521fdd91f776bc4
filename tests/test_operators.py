"""Operators on small tables with results worked out by hand."""

import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F

from lodestack.functions import finance as fn
from lodestack.functions import strings as st
from lodestack.operators import classify, evolve, graph, inventory, metrics, pages, registry, tables, textstyle, wiki
from lodestack.operators.rules import count_true, first_failure
from lodestack.operators.validate import OK, validate
from lodestack.sources import documents, sinks


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def header(name="a-b", description="fine", extra=""):
    return f"---\nname: {name}\ndescription: {description}\n{extra}---\nbody\n".encode()


VALIDATOR = [
    ("missing", None, "SKILL.md not found"),
    ("bytes", b"\xff", "SKILL.md must be valid UTF-8:"),
    ("bom", "\ufeff".encode() + header(), "No YAML frontmatter found"),
    ("no fence", b"hello", "No YAML frontmatter found"),
    ("open", b"---\nname: a\n", "Invalid frontmatter format"),
    ("adjacent", b"---\n---\n", "Invalid frontmatter format"),
    ("yaml", b"---\nname: [\n---\n", "Invalid YAML in frontmatter:"),
    ("list", b"---\n- a\n---\n", "Frontmatter must be a YAML dictionary"),
    ("extra", b"---\nfoo: 1\n---\n", "Unexpected key(s) in SKILL.md frontmatter: foo. Allowed properties are: allowed-tools, description, license, metadata, name"),
    ("no name", b"---\ndescription: x\n---\n", "Missing 'name' in frontmatter"),
    ("no description", b"---\nname: x\n---\n", "Missing 'description' in frontmatter"),
    ("int", header("123"), "Name must be a string, got int"),
    ("case", header("Ab"), "Name 'Ab' should be hyphen-case (lowercase letters, digits, and hyphens only)"),
    ("start", header("-a"), "Name '-a' cannot start or end with a hyphen or contain consecutive hyphens"),
    ("twice", header("a--b"), "Name 'a--b' cannot start or end with a hyphen or contain consecutive hyphens"),
    ("64", header("a" * 64), OK),
    ("65", header("a" * 65), "Name is too long (65 characters). Maximum is 64 characters."),
    ("list description", header(description="[a]"), "Description must be a string, got list"),
    ("brackets", header(description="a -> b"), "Description cannot contain angle brackets (< or >)"),
    ("1024", header(description="x" * 1024), OK),
    ("1025", header(description="x" * 1025), "Description is too long (1025 characters). Maximum is 1024 characters."),
    ("empty", header('""', '""'), OK),
    ("crlf", header().replace(b"\n", b"\r\n"), OK),
    ("four dashes", header().replace(b"\n---\nbody", b"\n----\nbody"), OK),
    ("keys", header(extra="metadata: {a: 1}\nlicense: x\n"), OK),
]


def test_validator(spark):
    df = spark.createDataFrame([(n, c) for n, c, _ in VALIDATOR], "name string, content binary")
    got = {r["name"]: (r["message"], r["valid"]) for r in validate(df).collect()}
    for name, _, message in VALIDATOR:
        assert got[name][0] == message or (message.endswith(":") and got[name][0].startswith(message)), name
        assert got[name][1] == (message == OK)
    assert not validate(df.where("name = '64'"), strict_name=True).first()["valid"]


def test_folders_and_archive(spark, tmp_path):
    sinks.scaffold(str(tmp_path / "root"), "my-tool", {"SKILL.md": "---\nname: {{NAME}}\ndescription: {{TITLE}}\n---\n"})
    (tmp_path / "root/empty/scripts").mkdir(parents=True)
    (tmp_path / "root/empty/scripts/x.py").write_text("pass")
    with pytest.raises(FileExistsError):
        sinks.scaffold(str(tmp_path / "root"), "my-tool", {})
    files = documents.walk(spark, str(tmp_path / "root"))
    assert sorted(r["relative"] for r in files.collect()) == ["empty/scripts/x.py", "my-tool/SKILL.md"]
    assert [r["name"] for r in documents.child_folders(files).collect()] == ["empty", "my-tool"]
    got = {r["name"]: r["message"] for r in validate(documents.member_content(files)).collect()}
    assert got == {"empty": "SKILL.md not found", "my-tool": OK}
    path = sinks.archive(str(tmp_path / "root/my-tool"), str(tmp_path / "out"))
    assert zipfile.ZipFile(path).namelist() == ["my-tool/SKILL.md"]


def test_inventory(spark):
    platform = spark.createDataFrame([(f"p{i}",) for i in range(1, 6)], "id string")
    local = spark.createDataFrame([("p1", "done", "t"), ("p2", "done", "t"), ("p2", "done", "t"), ("p4", "failed", "t"), ("p6", "done", None)], "id string, status string, title string")
    state = {r["id"]: r["state"] for r in inventory.completeness(platform, local, "id").collect()}
    assert state == {"p1": "complete", "p2": "duplicate", "p3": "missing", "p4": "complete", "p5": "missing", "p6": "extra"}
    assert [r["id"] for r in local.where(inventory.lacks("title") == "title").collect()] == ["p6"]
    more = platform.unionByName(spark.createDataFrame([("p7",)], "id string"))
    assert sorted(r["id"] for r in inventory.unprocessed(more, local, "id").collect()) == ["p3", "p5", "p7"]
    gate = spark.createDataFrame([("/home/u/a.md",), ("C:\\Users\\u\\a",), ("the transcript says hello",), ("A plain note.",)], "t string")
    assert [r[0] for r in gate.select(inventory.blocked(F.col("t"))).collect()] == [True, True, True, False]
    assert one(spark, inventory.gone(F.lit("Private")))[0]
    faults = spark.createDataFrame([("a", "a", 10, 10, "x. y"), ("a", "b", 10, 10, "x."), ("a", "a", 20, 10, "x."), ("a", "a", 10, 10, " "), ("a", "a", 10, 10, "x.\nx.\nx."), ("a", "a", 10, 10, "x")], "t string, e string, d int, x int, s string")
    assert [r[0] for r in faults.select(inventory.transcript_fault(*(F.col(c) for c in "tedxs"))).collect()] == ["ok", "title", "duration", "empty", "boilerplate", "punctuation"]


def test_graph(spark):
    nodes = spark.createDataFrame([(x,) for x in "abcde"], "page_id string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "src string, dst string")
    assert {r["page_id"] for r in wiki.orphans(nodes, edges).collect()} == {"d", "e"}
    assert {r["node"]: r["downstream"] for r in graph.downstream(nodes, edges, 4).collect()} == {"a": 2, "b": 2, "c": 2, "d": 3, "e": 0}
    assert {r["node"] for r in graph.on_cycle(edges).collect()} == {"a", "b", "c"}
    assert {(r["src"], r["dst"]) for r in graph.reachable(edges, 1).collect()} == {tuple(r) for r in edges.collect()}
    assert {(r["src"], r["dst"]) for r in graph.second_degree(edges).collect()} == {("a", "c"), ("b", "a"), ("c", "b"), ("d", "b")}
    dated = nodes.withColumn("type", F.lit("sources"))
    report = wiki.lint_report(dated, edges.withColumn("kind", F.lit("promote")))
    assert {(r["fault"], r["page_id"]) for r in report.collect()} == {("orphan", "d"), ("orphan", "e"), ("unpromoted", "e")}


def test_pattern_library(spark):
    p = spark.createDataFrame([("p1", "performance", 3, 1), ("p2", "quality", 0, 0), ("p3", "performance", 1, 1)], "id string, category string, success_count int, failure_count int")
    rates = {r["id"]: r["r"] for r in p.select("id", evolve.success_rate(F.col("success_count"), F.col("failure_count")).alias("r")).collect()}
    assert rates == {"p1": 0.75, "p2": None, "p3": 0.5}
    assert tuple(evolve.library_meta(p).first()) == (4, "performance")
    assert tuple(evolve.library_meta(p.limit(0)).first()) == (0, None)
    runs = spark.createDataFrame([("t1", "A", 10.0, 100, 2), ("t1", "B", 6.5, 90, 4)], "task string, agent string, elapsed double, tokens long, score int")
    r = evolve.paired(runs, ["task"], "agent", "A", "B", "elapsed", "score").first()
    assert r["elapsed_change"] == pytest.approx(-0.35)
    assert r["score_gap"] == 2
    fed = evolve.apply_feedback(p, spark.createDataFrame([("p1", True), ("p2", False), ("p2", False), ("p2", False)], "id string, success boolean"))
    assert {r["id"]: (r["success_count"], r["failure_count"], r["demoted"]) for r in fed.collect()} == {"p1": (4, 1, False), "p2": (0, 3, True), "p3": (1, 1, False)}


def test_style(spark):
    rows = spark.createDataFrame([("不是快，而是稳。不是多，而是准。",), ("结束\n希望对你有所帮助",), ("a—b—c",), ("x. x.",)], "t string")
    t = F.col("t")
    got = rows.select(textstyle.stock_sentences(t), textstyle.label_ending(t), F.regexp_count(t, F.lit("—")), textstyle.repetition(textstyle.sentences(t))).collect()
    assert got[0][0] == 2
    assert got[1][1] is True
    assert got[2][2] == 2
    assert got[3][3] == 0.5


def test_site_notes(spark):
    text = "---\ndomain: x\naliases: [微信公众号, WeChat MP , wechat]\n---\nA\n---\nB"
    files = spark.createDataFrame([("/n/mp.example.com.md", text), ("/n/other.md", "---\nx")], "path string, text string")
    notes = {r["domain"]: r for r in pages.note_from_file(files).collect()}
    assert notes["mp.example.com"]["body"] == "A\nB"
    assert notes["mp.example.com"]["aliases"] == "微信公众号|WeChat MP |wechat"
    assert notes["other"]["body"] == ""
    inputs = spark.createDataFrame([("打开微信公众号后台",), ("WECHAT login",), ("mpXexampleXcom",), ("example.org",), ("",)], "q string")
    hits = pages.site_match(inputs, "q", pages.note_from_file(files).where("domain != 'other'"))
    assert sorted(r["q"] for r in hits.collect()) == ["WECHAT login", "mpXexampleXcom", "打开微信公众号后台"]


def test_finance(spark):
    df = spark.createDataFrame([("e", i, v) for i, v in enumerate([10.0, 12.0, 14.0, 16.0, 18.0], 1)], "entity string, period int, value double")
    t = metrics.trailing_sum(metrics.change(metrics.change(df, "value", ["entity"], "period", 1, "qoq"), "value", ["entity"], "period", 4, "yoy"), "value", ["entity"], "period")
    rows = {r["period"]: r for r in t.collect()}
    assert [rows[i]["ttm"] for i in range(1, 6)] == [None, None, None, 52, 60]
    assert rows[5]["yoy"] == pytest.approx(0.8)
    assert rows[5]["qoq"] == pytest.approx(0.125)
    L = F.lit
    r = one(
        spark, fn.pe(L(20.0), L(2.0)), fn.pe(L(20.0), L(-1.0)), fn.perpetuity(L(100.0), L(0.1)), fn.perpetuity(L(100.0), L(0.1), L(0.02)), fn.perpetuity(L(100.0), L(0.1), L(0.1)),
        fn.discounted(L(10.0), L(0.1), L(1)) + fn.discounted(L(10.0), L(0.1), L(2)), fn.profit(fn.revenue(L(1000.0), L(0.5), L(2.0), L(3.0)), L(0.25), L(100.0)), fn.runway(L(1400.0), L(240.0)),
        fn.closing_stock(L(100), L(50), L(10), L(60), L(5)), fn.posterior(L(0.01), L(0.9), L(0.05)), fn.leveraged(L(0.1), L(0.05), L(2)), fn.two_stage(L(100.0), L(0.1), L(0.0), 1, L(0.0)),
    )
    assert [None if v is None else round(float(v), 6) for v in r] == [10, None, 1000, 1275, None, 17.355372, 650, 5.833333, 95, 0.153846, 0.15, 1000]
    assert [one(spark, fn.penetration_alert(L(x)))[0] for x in (0.49, 0.51, 0.8)] == ["ok", "caution", "saturated"]
    assert [one(spark, fn.model_grade(*(L(bool(x)) for x in a)))[0] for a in ((1, 1, 1), (1, 0, 1), (0, 0, 1), (0, 0, 0))] == [3, 2, 1, 0]
    assert [one(spark, fn.stock_regime(L(s), L(d)))[0] for s, d in ((1, 1), (1, -1), (-1, -1), (-1, 1), (0, 1))] == ["active build-up", "passive build-up", "active draw-down", "passive draw-down", None]


def test_strings(spark):
    L = F.lit
    assert one(spark, st.title_case(L("my-api--x2y")))[0] == "My Api  X2y"
    assert one(spark, st.fill("{{A}} of {{B}}", A=L("x"), B=L(3)))[0] == "x of 3"
    assert one(spark, st.strip_unicode(L("\u3000 a b\u00a0\n")))[0] == "a b"
    assert [one(spark, st.int_or(L(x), -1))[0] for x in ("12", " 7x", "x", "")] == [12, 7, -1, -1]
    assert one(spark, st.int_or(L("7x"), -1, prefix=False))[0] == -1
    assert one(spark, st.major_version(L("v22.1")))[0] == 22
    assert one(spark, st.full_lines(L("a\r\n\n b \n17")))[0] == ["a", "b", "17"]
    assert one(spark, st.query_map(L("http://h/p?a=1&b=&a=2#f")))[0] == {"a": "2", "b": ""}
    assert one(spark, st.session_stamp(L("run-20240102-030405")))[0] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, st.session_stamp(L("run")))[0] is None
    assert one(spark, st.iso_date(L("2024-02-30")))[0] is None
    assert one(spark, st.lookup({"a": "x"}, L("b"), "none"))[0] == "none"
    assert one(spark, st.safe_filename(L("  A/b: c "), L("id1")))[0] == "A_b_c__id1"
    assert one(spark, st.key_difference(F.array(L("z"), L("a"), L("name")), ["name"]))[0] == "a, z"
    assert one(spark, st.value_then_error(L(None).cast("string"), L("e"), L("r")))[0] == "e"


def test_rules_and_classes(spark):
    L = F.lit
    assert one(spark, first_failure([(L(None).cast("boolean"), "a"), (L(True), "b"), (L(True), "c")]))[0] == "b"
    assert one(spark, count_true(L(True), L(None).cast("boolean"), L(False)))[0] == 1
    assert [one(spark, classify.route(L(x), tables.ROUTES))[0] for x in ("请帮我分析一下", "整理笔记", "写公众号", "x")] == ["思维分析", "笔记处理", "公众号创作", "none"]
    rules = [(p, m, d) for m, p, d in tables.WRITING_MODES]
    assert one(spark, classify.matched(L("帮我写一篇"), rules, ["mode", "deliverable"])["deliverable"])[0] == "完整初稿"
    assert one(spark, classify.matched(L("x"), rules, ["mode", "deliverable"]))[0] is None
    with pytest.raises(ValueError):
        classify.bounded_rows(spark.range(5), 4)
    roles = ["a/.git/x", "tmp/a", "wiki/a.md", "a.py", "outputs/a", "a.md", "raw/b.md"]
    assert [one(spark, classify.file_role(L(x)))[0] for x in roles] == ["noise", "temporary", "knowledge", "script", "output", "raw", "raw"]
    assert [one(spark, classify.workspace_mode(L(a), L(b)))[0] for a, b in ((True, True), (True, False), (False, True), (False, False))] == ["hybrid", "structure-first", "compilation-first", "compilation-first"]
    assert one(spark, classify.display_form(L(3), L(2), L(False)))[0] == "table"
    found = classify.route_join(spark.createDataFrame([("x y",), ("q",)], "t string"), "t", spark.createDataFrame([("b", 2, "x"), ("a", 1, "Y")], "label string, priority int, pattern string"))
    assert {r["t"]: r["label"] for r in found.collect()} == {"x y": "a", "q": None}


def test_registry_and_sinks(spark, tmp_path):
    a = spark.createDataFrame([("A",), ("b",)], "n string")
    assert [r["n"] for r in registry.allowed_only(a, "n", spark.createDataFrame([("a",), ("a",)], "w string")).collect()] == ["A"]
    ok, missing = registry.split_missing(a, spark.createDataFrame([("b",)], "n string"), "n")
    assert ([r["n"] for r in ok.collect()], [r["n"] for r in missing.collect()]) == (["b"], ["A"])
    assert one(spark, registry.without_line(F.lit("x\ny\nx"), "x", F.lit(True)))[0] == "y"
    path = str(tmp_path / "t")
    sinks.write_if_absent(a, path)
    sinks.write_if_absent(a.limit(0), path)
    assert spark.read.parquet(path).count() == 2
    sinks.append_log(a, path)
    sinks.replace_table(spark.read.parquet(path).where("n = 'A'"), path)
    assert [r["n"] for r in spark.read.parquet(path).collect()] == ["A", "A"]
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert {tuple(r) for r in sinks.upsert(old, new, "k").collect()} == {(1, "a"), (2, None), (3, "c")}


def test_csv_and_json(spark, tmp_path):
    from lodestack.schemas import PATTERN_LIBRARY, PUBLIC_COLUMNS

    (tmp_path / "i.csv").write_text("date,platform_id,title,series,subseries,knowledge_theme,duration,play_count,url,status,local_transcript_path\n2024-01-02,p1,T,,,,60,5,u,done,/x\n")
    df = documents.read_csv(spark, str(tmp_path / "i.csv"))
    assert df.select(PUBLIC_COLUMNS).first()["duration"] == 60
    (tmp_path / "l.json").write_text('{"patterns": [], "meta": {"total_evolutions": 0, "most_effective_category": null}}')
    assert documents.read_json(spark, str(tmp_path / "l.json"), PATTERN_LIBRARY).first()["patterns"] == []


def test_properties(spark):
    a, b = spark.range(0, 10).withColumnRenamed("id", "k"), spark.range(5, 15).withColumnRenamed("id", "k")
    both = registry.consistency(a, b, "k")
    assert both.count() == a.union(b).distinct().count()
    assert inventory.unprocessed(a, b, "k").count() + a.join(b, "k", "left_semi").count() == a.count()


def test_port_file(spark):
    got = [one(spark, documents.port_file(F.lit(x)))[0] for x in ("9222\n/p", "9222", "0", "65536", "x", "\n 80\n", None)]
    assert [r and tuple(r) for r in got] == [(9222, "/p"), (9222, None), None, None, None, (80, None), None]


def test_archives_and_scaffolds(spark):
    files = spark.createDataFrame([("a", "x/1.txt", b"one"), ("a", "2.txt", b""), ("b", "é.txt", None)], "folder string, relative string, content binary")
    back = {(r["folder"], r["relative"], bytes(r["content"])) for r in sinks.unarchived(sinks.archived(files)).collect()}
    assert back == {("a", "x/1.txt", b"one"), ("a", "2.txt", b""), ("b", "é.txt", b"")}
    assert sinks.unarchived(sinks.archived(files.where("false"))).count() == 0
    names = spark.createDataFrame([("my-api",), ("my-api",), ("old",)], "folder string")
    got = sinks.scaffolded(names, {"R.md": "{{NAME}}: {{TITLE}}"}, spark.createDataFrame([("old",)], "folder string")).collect()
    assert [tuple(r) for r in got] == [("my-api", "R.md", "my-api: My Api")]


def test_reachable_at_any_distance(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(30, 31), (31, 30)], "src long, dst long")
    assert graph.reachable(chain).count() == 20 * 21 // 2 + 4
    assert {r["node"] for r in graph.on_cycle(chain).collect()} == {30, 31}
    assert graph.reachable(chain, 3).where("src = 0").count() == 3
    assert graph.reachable(chain, 0).count() == 0


def test_backtest(spark):
    rows = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 6.0), (3, 1.0, 7.0), (4, 2.0, 6.0), (5, 3.0, 9.0)], "p int, x double, y double")
    assert tuple(metrics.backtest(rows, "x", "y", [], "p").first()) == (3, 3, 1.0)


def test_site_notes_are_bounded(spark, monkeypatch):
    texts = spark.createDataFrame([("打开微信公众号后台",), ("WECHAT mp login",), ("mpXweixinXqqXcom",), ("example.org",), ("",), (None,)], "t string")
    notes = spark.createDataFrame([("mp.weixin.qq.com", "微信公众号|wechat mp", "b"), ("other.site", None, None)], "domain string, aliases string, body string")
    assert sorted(r["t"] for r in pages.site_match(texts, "t", notes).collect()) == ["WECHAT mp login", "mpXweixinXqqXcom", "打开微信公众号后台"]
    assert pages.site_match(texts, "t", notes.where("false")).count() == 0


def test_texts_that_hold_passages(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "xa b c d e f gx and more"), (3, "b c d e"), (4, "short one"), (5, ""), (6, "a b c d e f x")], "id long, t string")
    items = spark.createDataFrame([(1, "a b c d e f g"), (2, "c d e f g h i"), (3, "one"), (4, "d e"), (5, "b c d e f x")], "item long, p string")
    got = {tuple(r) for r in textstyle.holding(docs, "id", "t", items, "item", "p").collect()}
    assert got == {(r["id"], i["item"]) for r in docs.collect() for i in items.collect() if i["p"] in r["t"]}
    assert textstyle.holding(docs, "id", "t", items.where("false"), "item", "p").count() == 0
