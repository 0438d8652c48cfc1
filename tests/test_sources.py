"""Clients, connectors, landed batches and bronze runs against recorded replies."""

import hashlib
import json

import pytest

from lexloom.functions import ids
from lexloom.operators import bronze, dq, runs
from lexloom.sources import connectors, datasource, http, landing
from lexloom.sources.http import Reply
from lexloom.tables import TableStore

SETTINGS = {
    "ingestion": {"bclaws": {"base_url": "https://site/", "document_path": "/doc/{document_id}", "user_agent": "ua"}, "github": {"owner": "o", "repo": "r", "branch": "main", "root_path": "regs/"}, "allowed_extensions": [".txt", ".XML"], "max_file_size_mb": 1},
    "http": {"max_retries": 1},
}
SOURCES = [
    {"source_id": "a", "connector": "bclaws", "document_id": "1_a", "status": "approved", "doc_type": "act", "jurisdiction": "BC", "title": "A"},
    {"source_id": "b", "connector": "bclaws", "document_id": "2_b", "status": "approved", "doc_type": "act", "jurisdiction": "BC", "title": "B"},
    {"source_id": "p", "connector": "bclaws", "document_id": "3_p", "status": "pending", "doc_type": "act", "jurisdiction": "BC", "title": "P"},
    {"source_id": "g", "connector": "github", "repo_path": "regs/", "status": "approved", "doc_type": "regulation", "jurisdiction": "ON", "title": "G"},
    {"source_id": "gx", "connector": "github", "repo_path": "regs/x/", "status": "pending", "doc_type": "regulation", "jurisdiction": "ON", "title": "GX"},
]


class Web:
    """Replies by URL; what was asked stays in calls."""

    def __init__(self, pages):
        self.pages, self.calls = pages, []

    def __call__(self, method, url, params, headers, body, timeout):
        self.calls.append((method, url, params, headers, body))
        found = self.pages.get(url, Reply(404))
        found = found.pop(0) if isinstance(found, list) else found
        if isinstance(found, Exception):
            raise found
        if found.headers.get("ETag") and headers.get("If-None-Match") == found.headers["ETag"]:
            return Reply(304)
        return found


def client(replies, waits, **kw):
    it = iter(replies)

    def send(*_):
        r = next(it)
        if isinstance(r, Exception):
            raise r
        return r

    return http.ApiClient(send, "c", "r", sleep=waits.append, now=lambda: 1000.0, **kw)


def test_client_waits_and_gives_up():
    waits: list[float] = []
    assert client([Reply(503), TimeoutError(), Reply(200)], waits).get("http://h/p").status_code == 200
    assert 1 <= waits[0] <= 1.5 and 2 <= waits[1] <= 2.5
    waits.clear()
    client([Reply(429, {"Retry-After": "7"}), Reply(200)], waits).get("http://h/p")
    client([Reply(403, {"X-RateLimit-Remaining": "0", "x-ratelimit-reset": "1060"}), Reply(200)], waits).get("http://h/p")
    client([Reply(403, {"X-RateLimit-Remaining": "0"}), Reply(200)], waits).get("http://h/p")
    client([Reply(429, {"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": "1899"}), Reply(304)], waits).get("http://h/p")
    assert waits == [7.0, 61.0, 1.0, 900.0]
    for bad, status in (([Reply(404)], 404), ([Reply(501)], 501), ([Reply(505)], 505), ([ConnectionError()] * 6, None), ([Reply(403, {"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": "1900"})], 403), ([Reply(503)] * 6, 503)):
        with pytest.raises(http.RequestFailed) as e:
            client(bad, []).get("http://h/p")
        assert e.value.status == status


def test_the_client_and_the_column_decide_alike(spark):
    """Every attempt by the table of waits, as a column and by the client; without its jitter."""
    tries = [
        (503, 1, None, None, None, 1.0), (502, 2, "x", 5, None, 2.0), (429, 1, "7", 5, None, 7.0), (403, 1, None, 0, 60, 61.0), (403, 1, None, 0, 5000, None), (404, 1, None, 9, None, None), (None, 3, None, None, None, 4.0), (403, 1, None, 4, 10, None), (501, 1, None, None, None, None),
        (505, 1, "3", None, None, None), (429, 2, None, 0, None, 1.0), (403, 1, None, 0, 899, 900.0), (403, 1, None, 0, 900, None), (503, 4, "12", 0, 60, 12.0), (429, 1, "9", 0, -5, 1.0), (500, 3, "", None, None, 4.0), (504, 1, "1.5", None, None, 1.0),
    ]
    f = landing.F
    df = spark.createDataFrame([(k, *t) for k, t in enumerate(tries)], "k int, status int, attempt int, after string, remaining int, reset int, wait double")
    got = df.select("k", "wait", ids.retry_wait(*map(f.col, ("status", "attempt", "after", "remaining", "reset"))).alias("got")).collect()
    assert [r.got for r in got] == [r.wait for r in got]
    for status, attempt, after, remaining, reset, wait in tries:
        heads = {"Retry-After": after, "X-RateLimit-Remaining": None if remaining is None else str(remaining), "X-RateLimit-Reset": None if reset is None else str(1000 + reset)}
        got = client([], []).decision(None if status is None else Reply(status, {k: v for k, v in heads.items() if v is not None}), attempt)
        assert (got is None) == (wait is None) and (wait is None or wait <= got <= wait + 0.5), (status, got, wait)


def test_post_json_pages_and_the_audit_rows():
    web = Web({"http://h/a": Reply(200, {"link": '<http://h/a?page=2>; rel="next", <http://h/z>; rel="last"'}, b"[1, 2]"), "http://h/a?page=2": Reply(200, {}, b"[3]"), "http://h/p": [Reply(500), Reply(200, {"X-RateLimit-Remaining": "5"}, b'{"x": 1}')]})
    c = http.ApiClient(web, "c", "r", "http://h/", {"User-Agent": "u"}, sleep=lambda _: None)
    assert list(c.items("/a", {"q": 1})) == [1, 2, 3]
    assert [x[2] for x in web.calls] == [{"q": 1}, None] and web.calls[0][3] == {"User-Agent": "u"}
    assert json.loads(c.post("/p", {"in": 1}).content) == {"x": 1} and web.calls[-1][0] == "POST" and web.calls[-1][4] == {"in": 1}
    assert [(r["method"], r["endpoint"], r["status_code"], r["attempt"], r["error_type"], r["rate_limit_remaining"]) for r in c.log] == [("GET", "/a", 200, 1, None, None), ("GET", "/a", 200, 1, None, None), ("POST", "/p", 500, 1, "HTTP500", None), ("POST", "/p", 200, 2, None, 5)]


SITE = {
    "https://site/doc/1_a/xml": Reply(200, {"ETag": "e1", "Last-Modified": "m"}, b"<a/>"),
    "https://site/doc/2_b": Reply(200, {}, b"<html/>"),
}


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}/lake")


def site(pages):
    return connectors.build("bclaws", SETTINGS, "", Web(dict(pages)), sleep=lambda _: None)


def test_a_site_is_loaded_once_and_asked_conditionally(spark, store, tmp_path):
    root = f"file://{tmp_path}/landing"
    rules = {"bronze.raw_documents": [dq.Rule("u", "unique", "doc_id"), dq.Rule("DQ-B-004", "custom"), dq.Rule("DQ-B-005", "custom")]}
    context = dq.Context(sources=spark.createDataFrame([(s["source_id"], s["status"]) for s in SOURCES], "source_id string, status string"), landing_root=root)
    load = lambda pages, **kw: bronze.ingest(store, site(pages), SOURCES, root, rules, context, **kw)
    out = load(SITE)
    assert (out["loaded"], out["skipped"], out["fell_back_to_html"], out["documents_checked"], out["api_calls"]) == (2, {"source_not_approved": 1}, ["2_b"], 2, 3)
    rows = {r.source_id: r for r in store.read("bronze.raw_documents").collect()}
    assert rows["a"].source_version == "e1" and rows["a"].mime_type == "application/xml" and rows["b"].file_name == "2_b.html" and rows["a"].jurisdiction == "BC"
    assert (tmp_path / "landing" / rows["a"].landing_path).read_bytes() == b"<a/>" and rows["a"].doc_id == hashlib.sha256(b"<a/>").hexdigest()
    again = load(SITE)
    assert (again["loaded"], again["skipped"]) == (0, {"source_not_approved": 1, "not_modified": 1, "duplicate_content": 1})
    assert load(SITE, full=True)["skipped"]["duplicate_content"] == 2
    assert store.read("ops.api_call_log").count() == 9 and {r.load_id for r in store.read("bronze.raw_documents").collect()} <= {r.run_id for r in store.read("ops.run_log").collect()}
    (tmp_path / "landing" / rows["a"].landing_path).write_bytes(b"other")
    with pytest.raises(dq.GateFailed, match="DQ-B-005"):
        load(SITE | {"https://site/doc/1_a/xml": Reply(200, {"ETag": "e2"}, b"<b/>")})
    assert json.loads(runs.mark(store, "bclaws", "1_a"))["etag"] == "e1"
    with pytest.raises(http.RequestFailed, match="without content"):
        load(SITE | {"https://site/doc/1_a/xml": Reply(200, {}, b"")})
    assert store.read("bronze.raw_documents").count() == 2


def repository(head, blobs, content=b"text"):
    api = "https://api.github.com/repos/o/r"
    tree = [{"path": p, "sha": s, "size": n, "type": "blob"} for p, s, n in blobs] + [{"path": "regs/dir", "sha": "t", "type": "tree"}]
    pages = {f"{api}/commits/main": Reply(200, {}, json.dumps({"sha": head}).encode()), f"{api}/git/trees/{head}": Reply(200, {}, json.dumps({"tree": tree}).encode())}
    web = Web(pages | {f"{api}/git/blobs/{s}": Reply(200, {}, content + s.encode()) for _, s, _ in blobs})
    return connectors.build("github", SETTINGS, "", web, token="t", sleep=lambda _: None)


BLOBS = [("regs/a.txt", "s1", 5), ("regs/b.xml", "s2", 5), ("regs/README.md", "s3", 5), ("regs/.x", "s4", 5), ("regs/x/c.txt", "s5", 5), ("regs/d.pdf", "s6", 5), ("regs/e.txt", "s7", 2 << 20), ("other/f.txt", "s8", 1)]


def test_a_repository_is_listed_only_if_its_head_moved(spark, store, tmp_path):
    root = f"file://{tmp_path}/landing"
    c = repository("c1", BLOBS)
    out = bronze.ingest(store, c, SOURCES, root)
    assert (out["loaded"], out["files_seen"], out["api_calls"]) == (2, 7, 4) and c.client.headers["Authorization"] == "Bearer t"
    assert out["skipped"] == {"housekeeping": 2, "source_not_approved": 1, "extension_not_allowed": 1, "too_large": 1}
    same = bronze.ingest(store, repository("c1", BLOBS), SOURCES, root)
    assert same["up_to_date"] and same["api_calls"] == 1
    third = bronze.ingest(store, repository("c2", [*BLOBS[:2], ("regs/new.txt", "s9", 1)]), SOURCES, root)
    assert (third["loaded"], third["skipped"], third["api_calls"], runs.mark(store, "github", "o/r@main")) == (1, {"unchanged": 2}, 3, "c2")
    row = store.read("bronze.raw_documents").filter("file_name = 'new.txt'").first()
    assert (row.remote_hash, row.source_version, row.source_url) == ("s9", "c2", "https://github.com/o/r/blob/c2/regs/new.txt")
    truncated = connectors.build("github", SETTINGS, "", Web({"https://api.github.com/repos/o/r/git/trees/c": Reply(200, {}, b'{"tree": [], "truncated": true}')}))
    truncated.client.send.pages["https://api.github.com/repos/o/r/commits/main"] = Reply(200, {}, b'{"sha": "c"}')
    with pytest.raises(http.RequestFailed, match="truncated"):
        truncated.fetch(SOURCES, lambda _: set(), lambda *_: None)
    commits = http.ApiClient(Web({"https://api.github.com/repos/o/r/commits": Reply(200, {"Link": '<https://api.github.com/next>; rel="next"'}, b'[{"sha": "a"}]'), "https://api.github.com/next": Reply(200, {}, b'[{"sha": "b"}]')}), "github", "r", "https://api.github.com")
    assert [x["sha"] for x in connectors.history(commits, SETTINGS, "regs/a.txt")] == ["a", "b"] and commits.send.calls[0][2] == {"sha": "main", "per_page": 100, "path": "regs/a.txt"}


def test_one_connector_that_fails_does_not_stop_the_others(spark, store, tmp_path):
    load = lambda c: bronze.ingest(store, c, SOURCES, f"file://{tmp_path}/landing")
    out = bronze.ingest_all({"github": lambda: connectors.build("github", SETTINGS, "", Web({}), sleep=lambda _: None), "bclaws": lambda: site(SITE)}, load)
    assert out[0]["result"].startswith("FAILED") and out[1]["loaded"] == 2
    assert {(r.pipeline, r.status) for r in store.read("ops.run_log").collect()} == {("bronze_ingest:github", "FAILED"), ("bronze_ingest:bclaws", "SUCCEEDED")}
    with pytest.raises(ValueError, match="unknown connector"):
        connectors.build("none", SETTINGS, "")


def test_a_listing_is_judged_by_the_table_rule(spark):
    sources = [s for s in SOURCES if s["connector"] == "github"]
    items = [connectors.Item(p, p.rsplit("/", 1)[-1], "u", hash=s, size=n) for p, s, n in BLOBS]
    got = {i.ref: (why, i.source and i.source["source_id"]) for i, why in connectors.judged(items, sources, {"s1"}, (".txt", ".XML"), 1 << 20)}
    assert got == {
        "regs/a.txt": ("unchanged", "g"), "regs/b.xml": ("take", "g"), "regs/README.md": ("housekeeping", "g"), "regs/.x": ("housekeeping", "g"), "regs/x/c.txt": ("source_not_approved", "gx"),
        "regs/d.pdf": ("extension_not_allowed", "g"), "regs/e.txt": ("too_large", "g"), "other/f.txt": ("unregistered_path", None),
    }


def test_landed_batches_are_registered_whole_or_not_at_all(spark, store, tmp_path):
    root = f"file://{tmp_path}"
    bronze.fetch_to_landing(str(tmp_path), site(SITE), SOURCES, "load1")
    (tmp_path / "incoming/bclaws/2024-01-01/half").mkdir(parents=True)
    out = bronze.register(store, "bclaws", SOURCES, root)
    assert (out["batches"], out["loaded"], out["skipped"], out["api_calls"]) == (1, 2, {}, 3)
    rows = store.read("bronze.raw_documents").collect()
    assert all((tmp_path / r.landing_path).exists() for r in rows) and store.read("ops.api_call_log").select("run_id").distinct().count() == 1
    assert bronze.register(store, "bclaws", SOURCES, root)["result"] == "no new batches"
    second = bronze.fetch_to_landing(str(tmp_path), site(SITE | {"https://site/doc/1_a/xml": Reply(200, {}, b"<new/>")}), SOURCES, "load2")
    (second / "1_a.xml").write_bytes(b"tampered")
    for spoil in (lambda: None, lambda: (second / "1_a.xml").unlink()):
        spoil()
        with pytest.raises(dq.GateFailed, match="1_a.xml"):
            bronze.register(store, "bclaws", SOURCES, root)
    (second / "1_a.xml").write_bytes(b"<new/>")
    with pytest.raises(dq.GateFailed, match="isn't registered"):
        bronze.register(store, "bclaws", SOURCES[1:], root)
    assert store.read("bronze.raw_documents").count() == 2
    third = bronze.register(store, "bclaws", SOURCES, root)
    assert (third["loaded"], third["skipped"]) == (1, {"duplicate_content": 1})
    assert {(r.source_id, bytes(r.content)) for r in runs.latest_documents(store, "bclaws", root).collect()} == {("a", b"<new/>"), ("b", b"<html/>")}
    assert runs.latest_documents(store, "github", root).count() == 0


def test_a_fetch_that_fails_leaves_no_manifest(tmp_path):
    with pytest.raises(http.RequestFailed):
        bronze.fetch_to_landing(str(tmp_path), site({}), SOURCES, "x")
    assert not list(tmp_path.rglob("_manifest.json"))


def test_longest_prefix_keeps_repeated_files_and_unregistered_ones(spark):
    files = spark.createDataFrame([("src1/a",), ("src1/a",), ("src10/b",), ("other",), (None,)], "path string")
    sources = spark.createDataFrame([("src1", "s1"), ("src10", "s10"), ("s", "s")], "repo_path string, source_id string")
    got = sorted((str(r.path), r.source_id) for r in landing.longest_prefix(files, sources).collect())
    assert got == [("None", None), ("other", None), ("src1/a", "s1"), ("src1/a", "s1"), ("src10/b", "s10")]


def test_a_connector_as_a_data_source(spark):
    spark.dataSource.register(datasource.ConnectorSource)
    df = spark.read.format("lexloom_connector").option("connector", "tests_fixed").option("module", "tests.fixed").option("settings", "{}").option("sources", json.dumps([{"source_id": "z", "connector": "tests_fixed", "status": "approved"}, {"source_id": "y", "connector": "tests_fixed", "status": "pending"}])).load()
    assert [(r.source_id, r.file_name, bytes(r.content)) for r in df.collect()] == [("z", "z.txt", b"z")]


def test_a_connector_as_a_stream_goes_on_from_its_positions(spark, tmp_path):
    """Three fetches with a change between; a batch that failed comes again, and a merge by content keeps nothing twice."""
    root, sources = tmp_path / "service", [{"source_id": n, "connector": "tests_folder", "status": "approved" if n != "p" else "pending"} for n in ("a", "b", "p")]
    root.mkdir()
    for n in ("a", "b", "p"):
        (root / n).write_text(f"{n} one")
    spark.dataSource.register(datasource.ConnectorSource)
    seen, fail = [], []

    def batch(df, number):
        found = sorted((r.source_id, bytes(r.content).decode()) for r in df.collect())
        seen.append((number, found))
        if fail:
            raise RuntimeError(fail.pop())

    def run():
        stream = spark.readStream.format("lexloom_connector").option("connector", "tests_folder").option("module", "tests.fixed").option("settings", json.dumps({"root": str(root)})).option("sources", json.dumps(sources)).load()
        query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"file://{tmp_path}/checkpoint").trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    run()
    (root / "b").write_text("b two")
    fail.append("lost")
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    (root / "a").write_text("a three")
    run()
    told = [x for _, x in seen if x]
    assert told == [[("a", "a one"), ("b", "b one")], [("b", "b two")], [("b", "b two")], [("a", "a three")]]
    assert len({tuple(x) for x in told}) == 3 and seen[-1][1] == [("a", "a three")]
