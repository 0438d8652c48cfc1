"""Command line: python -m lexloom COMMAND.  Every command takes --root, --landing, --config-dir and --git-commit."""

from __future__ import annotations

import argparse
import sys
import uuid

from pyspark.sql import SparkSession

from lexloom import catalog, governance
from lexloom.config import Config, Runtime, secret
from lexloom.operators import answer, bronze, gateway, runs
from lexloom.sources import connectors
from lexloom.sources.http import ApiClient, urlsend
from lexloom.tables import TableStore

COMMANDS = ("bronze", "register", "fetch", "silver", "embed", "ask", "show", "smoke", "publish", "validate", "render")
LEGAL = "Not legal advice: the cited section is the authority."


class Session:
    """A command's configuration, and its Spark session and store once they are needed."""

    def __init__(self, args: argparse.Namespace, spark: SparkSession | None = None):
        self.args, self.runtime = args, Runtime.of(args)
        self.config = Config(self.runtime.config_dir)
        self._spark = spark

    @property
    def spark(self) -> SparkSession:
        if self._spark is None:
            self._spark = SparkSession.builder.appName("lexloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        return self._spark

    @property
    def store(self) -> TableStore:
        return TableStore(self.spark, self.runtime.shared(self.spark).root)

    def connector(self, name: str) -> connectors.Connector:
        more = {"token": token} if name == "github" and (token := secret("GITHUB_TOKEN")) else {}
        return connectors.build(name, self.config.settings, "", urlsend, **more)

    def embedder(self):
        """The configured model's endpoint, or the stand-in: (of chunks, of one text)."""
        own = self.config.settings["models"]["embeddings"]
        if not own.get("url"):
            made = runs.hash_embedder(own["dim"])
            one = lambda text: made(self.spark.createDataFrame([("q", text)], "chunk_id string, text string")).first().vector
            return made, one
        headers = {"Authorization": f"Bearer {secret('EMBEDDINGS_TOKEN') or ''}"}

        def send(texts: list[str]) -> list[dict]:
            import json

            return json.loads(ApiClient(urlsend, "embeddings", "", own["url"], headers).post("", {"input": texts}).content)["data"]

        return runs.batched_embedder(send, own["batch_size"], own["min_seconds_between_calls"]), lambda text: runs.in_order(send([text]))[0]

    def provider(self):
        found = {m.provider for m in gateway.models_of(self.config.settings)}
        urls = {p: self.config.settings["models"]["chat"].get("urls", {}).get(p) for p in found}
        made = {p: ApiClient(urlsend, p, "", u, {"Authorization": f"Bearer {secret(f'{p.upper()}_TOKEN') or ''}"}, attempts=2, timeout=60) for p, u in urls.items() if u}
        return gateway.chat_provider(made, dict.fromkeys(made, "/chat/completions")), list(made.values())


def bronze_(s: Session) -> list[str]:
    names = [s.args.connector] if s.args.connector else s.config.settings["ingestion"]["enabled_connectors"]
    context = s.config.context(s.spark, s.runtime.landing)
    load = lambda c: bronze.ingest(s.store, c, s.config.sources, s.runtime.landing, s.config.rules, context, s.args.full_refresh)
    out = bronze.ingest_all({n: (lambda n=n: s.connector(n)) for n in names}, load)
    s.failed = any(str(r.get("result", "")).startswith("FAILED") for r in out)
    return [f"{k}: {v}" for r in out for k, v in r.items()]


def register_(s: Session) -> list[str]:
    out = bronze.register(s.store, s.args.connector or "bclaws", s.config.sources, s.runtime.landing, s.config.rules, s.config.context(s.spark, s.runtime.landing))
    return [f"{k}: {v}" for k, v in out.items()]


def fetch_(s: Session) -> list[str]:
    folder = bronze.fetch_to_landing(s.args.out, s.connector(s.args.connector or "bclaws"), s.config.sources, str(uuid.uuid4()))
    return [f"batch: {folder}"]


def silver_(s: Session) -> list[str]:
    own = s.config.settings["chunking"]
    contents = runs.latest_documents(s.store, s.args.connector or "bclaws", s.runtime.landing)
    out = runs.build_silver(s.store, contents, bronze.source_frame(s.store, s.config.sources), s.config.rules, str(own["chunker_version"]), own["max_tokens"], own["target_tokens"], s.config.context(s.spark, s.runtime.landing), s.config)
    return [f"{k}: {v}" for k, v in out.items()]


def embed_(s: Session) -> list[str]:
    own = s.config.settings["models"]["embeddings"]
    out = runs.embed_chunks(s.store, s.embedder()[0], own["endpoint"], own["dim"], s.config.rules.get("gold.chunk_embeddings"), s.config.context(s.spark), s.config)
    return [f"{k}: {v}" for k, v in out.items()]


def ask_(s: Session) -> list[str]:
    own = s.config.settings["models"]
    library = answer.Library.open(s.store, f"{s.runtime.root}/_index", own["embeddings"]["endpoint"], s.config.sources)
    ask, clients = s.provider()
    g = gateway.Gateway.over(s.store, gateway.models_of(s.config.settings), ask, str(uuid.uuid4()), daily_tokens=own["chat"]["daily_token_budget"], clients=clients)
    try:
        r = answer.ask(s.args.question, library, g, s.embedder()[1], s.config)
    except gateway.Refused as e:
        s.failed = True
        return [f"No answer: {e}"]
    finally:
        g.flush(s.store, s.config.rules.get("gold.llm_call_log"))
    return [r.text, *(f"[{x.n}] {x.law}, {x.unit_ref}" + (f" (similarity {x.score})" if x.score is not None else "") for x in r.sources), f"route: {r.route}, model: {r.model or 'none'}, {r.latency_ms} ms", LEGAL]


def show_(s: Session) -> list[str]:
    """A table's first rows, a query over the views, or how many rows each table has."""
    s.store.views()
    if s.args.sql:
        df = s.spark.sql(s.args.sql)
    elif s.args.table:
        df = s.store.read(s.args.table).limit(s.args.limit)
    else:
        df = s.store.counts()
    return ["\t".join(df.columns), *("\t".join(map(str, r)) for r in df.collect())]  # a report for a reader


def smoke_(s: Session) -> list[str]:
    out = gateway.smoke_run(s.store, gateway.models_of(s.config.settings), s.provider()[0], s.config.rules.get("gold.llm_call_log"))
    return [f"{k}: {v}" for k, v in out.items()] + [f"{gateway.healthy(out)} of {len(out)} models answered"]


def publish_(s: Session) -> list[str]:
    return [f"{k}: {v}" for k, v in governance.publish(s.spark, s.args.prefix).items()]


def validate_(s: Session) -> list[str]:
    tables = list(s.config.tables.values())
    ruled = [(t, r) for t, rs in s.config.rules.items() for r in rs]
    found = governance.catalog_problems(s.spark, tables) + governance.rule_problems(s.spark, ruled, tables) + governance.source_problems(s.spark, s.config.sources)
    s.failed = bool(found)
    return found or ["no problems"]


def render_(s: Session) -> list[str]:
    return [catalog.markdown(s.config.tables, [(t, r) for t, rs in s.config.rules.items() for r in rs])]


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="lexloom", description=__doc__)
    sub = out.add_subparsers(dest="command", required=True)
    for name in COMMANDS:
        p = sub.add_parser(name)
        Runtime.flags(p)
        if name in ("bronze", "register", "fetch", "silver"):
            p.add_argument("--connector", choices=sorted(connectors.REGISTRY))
        if name == "bronze":
            p.add_argument("--full-refresh", action="store_true")
        if name == "fetch":
            p.add_argument("--out", default="outbox")
        if name == "ask":
            p.add_argument("question")
        if name == "show":
            p.add_argument("table", nargs="?")
            p.add_argument("--sql")
            p.add_argument("--limit", type=int, default=20)
        if name == "publish":
            p.add_argument("--prefix", default="")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    s = Session(parser().parse_args(argv), spark)
    s.failed = False
    print("\n".join(globals()[f"{s.args.command}_"](s)))
    return int(s.failed)


if __name__ == "__main__":
    sys.exit(main())
