"""Questions end to end, the gateway, governance, configuration, the warehouse store and the command line."""

import json
import math

import pytest

from lexloom import __main__ as cli
from lexloom import catalog, config, governance, rules
from lexloom.operators import answer, dq, gateway, route, runs, search
from lexloom.sources.http import ApiClient, Reply
from lexloom.sources.warehouse import Warehouse
from lexloom.tables import TableStore
from tests.test_engine import DOC

SOURCES = [{"source_id": "a", "title": "Harbour Regulation", "jurisdiction": "XX"}]


class Fake:
    """A model that says what it is told to, and remembers what it was asked."""

    def __init__(self, *texts):
        self.texts, self.asked = list(texts), []

    def __call__(self, model, messages):
        self.asked.append(messages)
        return self.texts.pop(0), 10, 5


@pytest.fixture(scope="module")
def library(spark, tmp_path_factory):
    store = TableStore(spark, f"file://{tmp_path_factory.mktemp('lake')}")
    sources = spark.createDataFrame([("a", "Harbour Regulation", "XX")], "source_id string, title string, jurisdiction string")
    runs.build_silver(store, spark.createDataFrame([("a", "1", bytearray(DOC))], "source_id string, doc_id string, content binary"), sources)
    runs.embed_chunks(store, runs.hash_embedder(256), "m", 256)
    return answer.Library.open(store, store.root + "/index", "m", SOURCES)


def embed_with(spark):
    made = runs.hash_embedder(256)
    return lambda text: made(spark.createDataFrame([("q", text)], "chunk_id string, text string")).first().vector


def put(spark, library, question, *texts, least=0.2):
    model = Fake(*texts)
    g = gateway.Gateway([gateway.Model("m", "p", ("confidential",))], model, "run")
    settings = config.Config(over={"rag": config.SETTINGS["rag"] | {"min_vector_score": least, "laws": {"a": ["harbour regulation"]}}})
    return answer.ask(question, library, g, embed_with(spark), settings), model


def test_routes(spark, library):
    r, m = put(spark, library, "What does section 13 say?", "Monthly [1].")
    assert (r.route, r.text, [s.unit_ref for s in r.sources], r.model) == ("lookup", "Monthly [1].", ["s. 13"], "m")
    assert "[1] [Harbour Regulation | s. 13]\nA drill is held once a month." in m.asked[0][1]["content"]
    r, m = put(spark, library, "Is section 15 of the Harbour Regulation in force?")
    assert r.route == "status" and not m.asked and "has not been brought into force" in r.text and r.model is None
    r, m = put(spark, library, "s. 30?")
    assert r.route == "status" and "History: [rep. 2001]" in r.text
    r, _ = put(spark, library, "section 12", "No source.")
    assert (r.route, r.text, r.sources) == ("ungrounded", answer.NOTHING, ())
    r, _ = put(spark, library, "section 12", "NOT_FOUND")
    assert (r.route, r.text) == ("not_found", answer.NOTHING)
    r, m = put(spark, library, "section 99: how often is a drill held", "Once a month [1][9].")
    assert r.route == "search" and r.sources[0].unit_ref == "s. 13" and 0.2 < r.sources[0].score <= 1
    assert all(s not in m.asked[0][1]["content"] for s in ("Repealed", "Not in force"))
    r, m = put(spark, library, "bicycle taxation", least=0.9)
    assert (r.route, r.text) == ("not_found", answer.NOTHING) and not m.asked
    assert library.loaded_on() is not None


def test_search_equals_plain_bm25_and_fusion(spark, tmp_path):
    docs = [(0, "drill drill access", [1.0, 0.0]), (1, "access the harbour", [0.0, 2.0]), (2, "", [0.0, 0.0]), (3, "harbour harbour drill", [3.0, 3.0])]
    corpus = spark.createDataFrame(docs, "id long, text string, v array<float>")
    index = search.SearchIndex.build(corpus, f"file://{tmp_path}/i", "id", "text", "v")
    asked = spark.createDataFrame([(7, "Drill the drill?", [2.0, 0.0])], "q long, question string, vector array<double>")
    words = {i: [w for w in t.split() if w != "the"] for i, t, _ in docs}
    mean, df = sum(map(len, words.values())) / 4, sum("drill" in w for w in words.values())
    bm = {i: math.log(1 + (4 - df + 0.5) / (df + 0.5)) * w.count("drill") * 2.5 / (w.count("drill") + 1.5 * (0.25 + 0.75 * len(w) / mean)) for i, w in words.items() if "drill" in w}
    got = {r.id: r.kw for r in index.keyword_scores(asked, "q", "question").collect()}
    assert got == pytest.approx(bm)
    cos = {0: 1.0, 1: 0.0, 2: 0.0, 3: math.sqrt(0.5)}
    top = index.vector_top(asked, "q", "vector", 3).collect()
    assert [(r.id, r.rank) for r in sorted(top, key=lambda r: r.rank)] == [(0, 1), (3, 2), (1, 3)] and all(r.vec == pytest.approx(cos[r.id], abs=1e-6) for r in top)
    best = {r.id: r.fused for r in index.search(asked, asked, "q", "question", "vector").collect()}
    by_kw = sorted(bm, key=lambda i: -bm[i])
    assert best[0] == pytest.approx(1 / 61 + 1 / (61 + by_kw.index(0)), abs=1e-9) and best[3] == pytest.approx(1 / 62 + 1 / (61 + by_kw.index(3)), abs=1e-9)
    none = corpus.limit(0)
    empty = search.SearchIndex.build(none, f"file://{tmp_path}/e", "id", "text", "v")
    assert empty.search(asked, asked, "q", "question", "vector").count() == 0


def test_laws_and_sections(spark):
    laws = spark.createDataFrame([("r", "Harbour Regulation", 0), ("x", "the act", 1), ("y", "the act", 2)], "source_id string, name string, position int")
    asked = ["the Act", "the Act", "the action", "the act and the harbour regulation", "a.b(c"]
    got = sorted(map(tuple, route.find_law(spark.createDataFrame([(q,) for q in asked], "question string"), laws).collect()))
    assert got == sorted(zip(asked, ["x", "x", None, "r", None], strict=True))
    units = spark.createDataFrame([("a", r, k, True) for k, r in enumerate(["s. 30-31", "s. 30", "s. 5-3", "s. 1-5000", "Sch. A, s. 30", "s. 2.1", "s. 030"])], "source_id string, unit_ref string, unit_order int, is_current boolean")
    find = lambda n, law=None: [r.unit_ref for r in route.lookup(spark.createDataFrame([(n, law)], "number string, law string"), units).collect()]
    assert find("30") == ["s. 30-31", "s. 30", "s. 1-5000"] and find("30-31") == ["s. 30-31"] and find("2.1") == ["s. 2.1"]
    assert find("4999") == ["s. 1-5000"] and find("030") == ["s. 30-31", "s. 1-5000", "s. 030"] and find("30", "b") == [] and find("4") == ["s. 1-5000"]


def test_gateway_failover_class_and_budget(spark, tmp_path):
    models = [gateway.Model("m1", "p", ("public",), 1.0, 2.0), gateway.Model("m2", "p", ("public", "internal"))]

    def ask(m, _):
        if m.name == "m1":
            raise TimeoutError
        return "fine", 10, 5

    g = gateway.Gateway(models, ask, "r", daily_tokens=30)
    assert g.chat([{"role": "user", "content": "secret words"}], "t").model == "m2"
    assert [(r["retry_count"], r["fallback_used"], r["status"]) for r in g.rows] == [(0, False, "error"), (0, True, "ok")]
    g.chat([], "t", "internal")
    for level in ("public", "confidential", "restricted", "unheard"):
        with pytest.raises(gateway.Refused):
            g.chat([], "t", level)
    store = TableStore(spark, f"file://{tmp_path}/lake")
    g.rows[0]["cost_usd"] = -1.0
    g.rows[1]["data_classification"] = "confidential"
    assert g.flush(store, rules.by_table(rules.SHIPPED)["gold.llm_call_log"]) == 3 and (g.report.critical, g.report.warnings) == (["DQ-G-011"], ["DQ-G-006"])
    assert "secret words" not in str(store.read("gold.llm_call_log").collect()) and store.read("ops.dq_results").count() == 2
    assert gateway.Gateway.over(store, models, ask, "r").used() == 30
    out = gateway.smoke_run(store, models, ask)
    assert gateway.healthy(out) == 1 and out["m1"].startswith("not available") and store.read("ops.run_log").filter("rows_out = 1").count() == 1


def test_a_provider_counts_its_retries_and_drops_reasoning():
    replies = iter([Reply(500), Reply(200, {}, json.dumps({"choices": [{"message": {"content": [{"type": "reasoning", "text": "hm"}, {"type": "text", "text": "yes"}]}}], "usage": {"prompt_tokens": 3, "completion_tokens": 1}}).encode())])
    ask = gateway.chat_provider({"p": ApiClient(lambda *_: next(replies), "p", "r", "http://h", sleep=lambda _: None)}, {"p": "/chat/{model}"})
    assert ask(gateway.Model("m", "p", ("public",)), []) == ("yes", 3, 1, 1)
    with pytest.raises(gateway.Unavailable):
        ask(gateway.Model("m", "q", ("public",)), [])


def test_shipped_governance_is_sound_and_faults_are_found(spark):
    tables, ruled = list(catalog.TABLES.values()), list(rules.SHIPPED)
    assert governance.catalog_problems(spark, tables) == governance.rule_problems(spark, ruled, tables) == []
    assert len(ruled) == 33 and {k: sum(r.rule_id[3] == k for _, r in ruled) for k in "BSGO"} == {"B": 8, "S": 10, "G": 11, "O": 4} and sum(r.severity == "critical" for _, r in ruled) == 27
    bad = catalog.Table("silver.x", ("id",), "merge", "id2 string, id2 thing", "Secret", "nobody", 0)
    found = governance.catalog_problems(spark, [*tables, bad, bad])
    assert all(any(x in f for f in found) for x in ("defined twice", "unknown classification", "no owner", "positive number", "load_id is missing", "key column id", "declared twice", "type thing"))
    odd = [("none", dq.Rule("r", "unique", "a")), ("silver.chunks", dq.Rule("r", "guess", "nope", severity="mild", dimension="taste")), ("silver.chunks", dq.Rule("f", "foreign_key", "doc_id", references="silver.none.id")), ("silver.chunks", dq.Rule("m", "min_value", "text"))]
    found = governance.rule_problems(spark, [*ruled, *odd], tables)
    assert all(any(x in f for f in found) for x in ("r: declared twice", "unknown table none", "unknown check guess", "unknown severity", "unknown dimension", "unknown column nope", "unknown reference", "m: check min_value needs threshold"))
    assert governance.rule_problems(spark, [], tables[:1]) == ["bronze.raw_documents: no rule"]


def test_sources_are_checked(spark):
    good = dict(source_id="s", connector="bclaws", document_id="1", title="t", publisher="p", url="u", doc_type="act", jurisdiction="ON", classification="Public", license_note="n", redistribute_raw=False, status="approved", approved_by="x", approved_on="2026-01-01")
    assert governance.source_problems(spark, [good]) == []
    for change, said in (({"jurisdiction": True}, "must be a string"), ({"document_id": None}, "needs document_id"), ({"connector": "ftp"}, "unknown connector"), ({"classification": "Internal"}, "only public"), ({"approved_by": ""}, "approval needs"), ({"doc_type": "memo"}, "not allowed"), ({"connector": "github", "repo_path": "x/"}, "must be below")):
        assert any(said in p for p in governance.source_problems(spark, [good | change])), change
    assert any("missing title" in p for p in governance.source_problems(spark, [{k: v for k, v in good.items() if k != "title"}]))
    twice = governance.source_problems(spark, [good, good])
    assert any("duplicate source_id" in p for p in twice) and any("more than one source" in p for p in twice)


def test_tables_are_described_to_the_metastore(spark):
    assert governance.quote_name("a.b`c") == "`a`.`b``c`" and governance.quote_text("it's \\ x") == "'it\\'s \\\\ x'"
    try:
        governance.create(spark, "ops.watermarks")
        out = governance.publish(spark)
        assert out["tables_published"] == 1 and out["refused"] == 0
        assert spark.table("ops.watermarks").columns[0] == "source_system"
        shown = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES ops.watermarks").collect()}
        assert shown["classification"] == "Internal" and shown["layer"] == "ops"
    finally:
        spark.sql("DROP DATABASE IF EXISTS ops CASCADE")


def test_configuration_files_take_the_place_of_what_is_shipped(tmp_path, monkeypatch):
    shipped = config.Config()
    assert shipped.hash() == config.Config().hash() and shipped.settings["rag"]["top_k"] == 5 and "NOT_FOUND" in shipped.prompt()
    (tmp_path / "prompts").mkdir()
    (tmp_path / "prompts/v2.md").write_text("two")
    (tmp_path / "settings.yaml").write_text("rag: {prompt_version: v2, laws: {a: [the act, act]}}\n")
    (tmp_path / "dq_rules.yaml").write_text("rules: [{id: X, table: ops.run_log, check: not_null, column: status, severity: warning, dimension: validity}]\n")
    (tmp_path / "sources.json").write_text('{"sources": [{"source_id": "z", "status": "approved"}]}')
    (tmp_path / "catalog.yaml").write_text("tables: [{name: ops.t, primary_key: [id], write_mode: append, classification: Internal, domain: platform, retention_days: 1, columns: [{name: id, type: string, nullable: false}, {name: n, type: long, nullable: true}]}]\n")
    own = config.Config(str(tmp_path))
    assert own.prompt() == "two" and own.settings["rag"]["top_k"] == 5 and own.laws() == [("a", "the act", 0), ("a", "act", 1)] and own.sources[0]["source_id"] == "z"
    assert own.rules["ops.run_log"][0].rule_id == "X" and own.tables["ops.t"].fields() == [("id", "string", False), ("n", "long", True)]
    before = own.hash()
    (tmp_path / "sources.json").write_text('{"sources": []}')
    assert own.hash() != before != shipped.hash()
    with pytest.raises(FileNotFoundError):
        shipped.prompt("v9")
    monkeypatch.setenv("LEXLOOM_GIT_COMMIT", "0123456789abcdef")
    assert config.commit_id() == "0123456789ab"
    (tmp_path / "key").write_text("k\n")
    monkeypatch.setenv("SOME_KEY_FILE", str(tmp_path / "key"))
    assert config.require("SOME_KEY") == "k"
    with pytest.raises(RuntimeError):
        config.require("NO_SUCH_KEY")


class Cursor:
    def __init__(self, log, tables):
        self.log, self.tables, self.found = log, tables, []

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False

    cursor = lambda self: self

    def execute(self, sql, bound=None):
        self.log.append((sql, bound))
        self.found = [("x",)] if sql.startswith("SHOW") and self.tables else [("s", "k", "v", None, "r")]

    def fetchall(self):
        return self.found if not self.log[-1][0].startswith("SHOW") else [("x",)] * bool(self.tables)


def test_a_warehouse_reads_columns_and_binds_rows(spark):
    log: list = []
    w = Warehouse(spark, lambda: Cursor(log, True), "db")
    df = spark.createDataFrame([("s", str(k), "it's", "r") for k in range(3)], "source_system string, scope string, watermark_value string, load_id string").selectExpr("*", "timestamp '2024-01-01' updated_at")
    assert w.append("ops.watermarks", df) == 3
    sql, bound = log[-1]
    assert sql.startswith("INSERT INTO `db`.`ops`.`watermarks` (`source_system`, ") and "it's" not in sql and bound["r2_watermark_value"] == "it's" and len(bound) == 15
    for refused in (w.overwrite, w.upsert, w.delete):
        with pytest.raises(NotImplementedError):
            refused("ops.watermarks", df)
    assert Warehouse(spark, lambda: Cursor(log, False), "db").read("ops.watermarks").count() == 0
    with pytest.raises(RuntimeError, match="isn't there"):
        Warehouse(spark, lambda: Cursor(log, False), "db").append("ops.watermarks", df)


def test_the_command_line(spark, tmp_path, capsys):
    where = ["--root", f"file://{tmp_path}/lake", "--landing", f"file://{tmp_path}/landing"]
    runs.set_mark(TableStore(spark, f"file://{tmp_path}/lake"), "s", "x", "v", "r")
    assert cli.main(["validate", *where], spark) == 0 and "no problems" in capsys.readouterr().out
    assert cli.main(["render", *where], spark) == 0 and "bronze.raw_documents" in capsys.readouterr().out
    assert cli.main(["show", *where], spark) == 0 and "ops.watermarks\t1" in capsys.readouterr().out
    assert cli.main(["show", "ops.watermarks", *where], spark) == 0 and "\tv\t" in capsys.readouterr().out
    assert cli.main(["show", "--sql", "SELECT count(*) AS n FROM ops_watermarks", *where], spark) == 0 and capsys.readouterr().out.split() == ["n", "1"]
    assert cli.main(["bronze", *where], spark) == 0
    with pytest.raises(SystemExit):
        cli.main(["nonsense"], spark)


def standing_in(m, messages):
    """A provider for executors: cites the block that the message's length names; one model never answers."""
    if m.name == "down":
        raise TimeoutError
    said = messages[1]["content"]
    return (f"As [{1 + len(said) % 4}] says." if len(said) % 5 == 0 else f"As [1] and [{1 + len(said) % 4}] say."), len(said.encode()) // 2, 7


def test_answers_of_a_table_equal_one_by_one(spark, library):
    models = [gateway.Model("down", "p", ("confidential",)), gateway.Model("m", "p", ("confidential",), 1.0, 1.0)]
    settings = config.Config(over={"rag": config.SETTINGS["rag"] | {"min_vector_score": 0.2, "laws": {"a": ["harbour regulation"]}}})
    asked = ["What does section 13 of the Harbour Regulation say?", "what does s. 12 say", "section 30-31", "How often is a drill held?", "bicycle taxation", "section 99: how often is a drill held", "How often is a drill held?", "access to the harbour"]
    embed = embed_with(spark)
    rows = spark.createDataFrame([(k, q, [float(x) for x in embed(q)]) for k, q in enumerate(asked)], "qid int, question string, q array<double>")
    got = {r.qid: r for r in answer.answers(rows, library, models, standing_in, "run", 10**9, settings).collect()}
    assert sorted(got) == list(range(len(asked)))
    for k, q in enumerate(asked):
        g = gateway.Gateway(models, standing_in, "run")
        one, r = answer.ask(q, library, g, embed, settings), got[k]
        assert (r.text, r.route, tuple(r.notes), r.model) == (one.text, one.route, one.notes, one.model), q
        assert [tuple(s) for s in r.sources] == [(s.n, s.source_id, s.law, s.unit_ref, s.status, s.score) for s in one.sources]
        assert [(c.model, c.status, c.error_type, c.fallback_used, c.prompt_tokens, c.cost_usd, c.request_hash) for c in r.calls] == [(c["model"], c["status"], c["error_type"], c["fallback_used"], c["prompt_tokens"], c["cost_usd"], c["request_hash"]) for c in g.rows]
    assert {"lookup", "status", "search", "not_found"} <= {r.route for r in got.values()}


def test_lanes_never_spend_more_than_is_left(spark, library):
    models = [gateway.Model("m", "p", ("confidential",))]
    settings = config.Config(over={"rag": config.SETTINGS["rag"] | {"min_vector_score": 0.0}})
    embed = embed_with(spark)
    vector = [float(x) for x in embed("drill")]
    rows = spark.createDataFrame([(k, f"How often is drill {k} held?", vector) for k in range(24)], "qid int, question string, q array<double>")
    whole = answer.answers(rows, library, models, standing_in, "run", 10**9, settings, lanes=4).collect()
    spent = sum(c.prompt_tokens + c.completion_tokens for r in whole for c in r.calls)
    sent = []
    for left in (0, spent, 3 * spent, 20 * spent):
        got = answer.answers(rows, library, models, standing_in, "run", left, settings, lanes=4).collect()
        assert len(got) == 24 and sum(c.prompt_tokens + c.completion_tokens for r in got for c in r.calls) <= left
        assert all((r.route == "budget") == (not r.calls) for r in got)
        sent.append(sum(bool(r.calls) for r in got))
    assert sent[0] == 0 < sent[1] <= sent[2] <= sent[3] == 24


def test_many_names_meet_questions_by_their_rarest_word(spark):
    import random
    import re

    rng = random.Random(6)
    words = [f"w{k}" for k in range(60)] + ["act", "of", "the", "(no.", "2)", "é", "c++", "\\E"]
    laws = [(f"s{k}", " ".join(rng.choices(words, k=rng.randrange(1, 5))), k % 700) for k in range(3000)] + [("x", "§", 1), ("y", "", 2)]
    asked = [" ".join(rng.choices(words, k=rng.randrange(1, 14))).replace("w1", rng.choice(["W1", "w1", "xw1"])) for _ in range(300)] + ["", "§ 4", None]
    asked += asked[:5]
    got = sorted((r.question or "", r.law or "") for r in route.find_law(spark.createDataFrame([(q,) for q in asked], "question string"), spark.createDataFrame(laws, "source_id string, name string, position int")).collect())
    want = []
    for q in asked:
        fit = [(-len(n), p, n.lower(), s) for s, n, p in laws if n and n.lower() in (q or "").lower() and re.search(rf"(?<![a-z0-9]){re.escape(n.lower())}(?![a-z0-9])", (q or "").lower())]
        want.append((q or "", min(fit)[3] if fit else ""))
    assert got == sorted(want)
