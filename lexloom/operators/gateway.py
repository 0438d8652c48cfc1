"""The model gateway: allowed classes, daily budget, ordered failover, one log row an attempt.  Providers are plug-ins."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom import catalog
from lexloom.operators import dq
from lexloom.operators.runs import start_run
from lexloom.sources.http import ApiClient


class Refused(RuntimeError):
    """No model may be asked: class not allowed, budget spent, or every model failed."""


class Unavailable(RuntimeError):
    """A model can't be asked at all (no key, no provider): the next one is, and nothing is logged."""


# The classes of data, by how far they may go.  Restricted data goes to no model.
LEVELS = ("public", "internal", "confidential", "restricted")


@dataclass(frozen=True)
class Model:
    name: str
    provider: str
    allowed: tuple[str, ...]
    price_in: float = 0.0
    price_out: float = 0.0


@dataclass
class Answer:
    text: str
    model: str
    prompt_tokens: int | None
    completion_tokens: int | None
    call_id: str | None = None


def models_of(settings: dict) -> list[Model]:
    """The models of a configuration in the order in which they are tried."""
    chat, prices = settings["models"]["chat"], settings.get("pricing", {})
    price = lambda name, side: float(prices.get(name, {}).get(f"{side}_per_1m", 0.0))
    return [Model(n, chat["models"][n]["provider"], tuple(chat["models"][n]["allowed_data"]), price(n, "input"), price(n, "output")) for n in chat["route"]]


def used_on(log: DataFrame, day: Column, prompt: str = "prompt_tokens", completion: str = "completion_tokens", at: str = "called_at") -> DataFrame:
    """One row, used: the tokens of a day's calls; unknown ones count as none."""
    return log.filter(F.to_date(at) == day).agg(F.coalesce(F.sum(F.coalesce(prompt, F.lit(0)) + F.coalesce(completion, F.lit(0))), F.lit(0)).alias("used"))


def request_hash(messages: list[dict]) -> str:
    return hashlib.sha256(json.dumps(messages, sort_keys=True).encode()).hexdigest()


def text_of(content) -> str:
    """A reply's text: a string, or the text blocks of a list (reasoning blocks don't count)."""
    return content if isinstance(content, str) else "".join(b.get("text") or "" for b in content or [] if b.get("type") == "text")


@dataclass
class Gateway:
    """ask(model, messages) gives (text, prompt tokens, completion tokens) or raises; it is the only way out.

    A reply may have a fourth part, the number of times that its provider tried again.
    """

    models: list[Model]
    ask: Callable[[Model, list[dict]], tuple]
    run_id: str
    daily_tokens: int = 200_000
    used_before: int = 0
    prompt_version: str = "1"
    rows: list[dict] = field(default_factory=list)
    #: Clients whose audit rows are saved with the log.
    clients: list = field(default_factory=list)

    @classmethod
    def over(cls, store, models: list[Model], ask: Callable[[Model, list[dict]], tuple], run_id: str, **kw) -> Gateway:
        """A gateway that counts what was used today, in any session."""
        today = F.lit(datetime.now(UTC).date())
        return cls(models, ask, run_id, used_before=used_on(store.read("gold.llm_call_log"), today).first()[0], **kw)

    def used(self) -> int:
        return self.used_before + sum((r["prompt_tokens"] or 0) + (r["completion_tokens"] or 0) for r in self.rows)

    def chat(self, messages: list[dict], purpose: str, classification: str = "public", prompt_version: str | None = None) -> Answer:
        level = classification.lower()
        if level not in LEVELS:
            raise Refused(f"unknown class {classification}")
        able = [m for m in self.models if level != "restricted" and level in map(str.lower, m.allowed)]
        if not able:
            raise Refused(f"no model may see {classification} data")
        if self.used() >= self.daily_tokens:
            raise Refused("the daily token budget is spent; nothing was sent")
        problems, first = [], None
        for m in able:
            began, problem, got = time.monotonic(), None, ("", None, None)
            try:
                got = self.ask(m, messages)
                problem = None if got[0].strip() else "EmptyAnswer"
            except Unavailable as e:
                problems.append(f"{m.name}: {e}")
                continue
            except Exception as e:  # noqa: BLE001  any failure moves on to the next model, and is logged
                problem = type(e).__name__
            first = first or m.name
            row = {
                "call_id": str(uuid.uuid4()), "called_at": datetime.now(UTC), "run_id": self.run_id, "purpose": purpose, "provider": m.provider, "model": m.name,
                "prompt_version": prompt_version or self.prompt_version, "data_classification": level, "prompt_tokens": got[1], "completion_tokens": got[2],
                "latency_ms": int(1000 * (time.monotonic() - began)), "status": "error" if problem else "ok", "error_type": problem, "retry_count": got[3] if len(got) > 3 else 0, "fallback_used": m.name != first,
                "cost_usd": round(((got[1] or 0) * m.price_in + (got[2] or 0) * m.price_out) / 1e6, 8), "request_hash": request_hash(messages),
            }
            self.rows.append(row)
            if not problem:
                return Answer(got[0], m.name, got[1], got[2], row["call_id"])
            problems.append(f"{m.name}: {problem}")
        raise Refused("no model answered: " + "; ".join(problems))

    def flush(self, store, rules: list[dq.Rule] | None = None, context: dq.Context | None = None) -> int:
        """Checks the log and appends it, whatever the checks say: the calls were made, and the log is the evidence."""
        n = 0
        if self.rows:
            spec = catalog.spec("gold.llm_call_log")
            df = store.spark.createDataFrame([tuple(r[c] for c, _, _ in spec.fields()) for r in self.rows], spec.schema())
            if rules:
                allowed = {m.name: tuple(map(str.lower, m.allowed)) for m in self.models}
                self.report = dq.run_checks(spec.name, df, rules, self.run_id, store, replace(context or dq.Context(), models=allowed))
            n = store.append(spec.name, df)
        for c in self.clients:
            c.flush(store)
        self.used_before, self.rows = self.used(), []
        return n


def chat_provider(clients: dict[str, ApiClient], paths: dict[str, str], temperature: float = 0.0, max_tokens: int = 800) -> Callable[[Model, list[dict]], tuple]:
    """ask() over chat endpoints: a client and a path (with {model}) for each provider; others are unavailable."""
    def ask(m: Model, messages: list[dict]) -> tuple:
        if m.provider not in clients:
            raise Unavailable(f"no client for {m.provider}")
        client = clients[m.provider]
        before = len(client.log)
        reply = json.loads(client.post(paths[m.provider].format(model=m.name), {"model": m.name, "messages": messages, "temperature": temperature, "max_tokens": max_tokens}).content)
        usage = reply.get("usage") or {}
        return text_of(reply["choices"][0]["message"]["content"]), usage.get("prompt_tokens"), usage.get("completion_tokens"), max(0, len(client.log) - before - 1)

    return ask


def smoke(gateway_of: Callable[[Model], Gateway], models: list[Model]) -> dict[str, str]:
    """Each model once, without fallback."""
    out = {}
    for m in models:
        try:
            out[m.name] = f"ok: {gateway_of(m).chat([{'role': 'user', 'content': 'Say ok.'}], 'smoke', prompt_version='smoke-v1').text[:120]}"
        except Refused as e:
            out[m.name] = f"not available: {e}"[:300]
    return out


def healthy(results: dict[str, str]) -> int:
    """How many models answered."""
    return sum(v.startswith("ok") for v in results.values())


def smoke_run(store, models: list[Model], ask: Callable[[Model, list[dict]], tuple], rules: list[dq.Rule] | None = None) -> dict[str, str]:
    """smoke() with a receipt, and its calls logged."""
    with start_run(store, "gateway_smoke") as run:
        made = {m.name: Gateway.over(store, [m], ask, run.run_id) for m in models}
        out = smoke(lambda m: made[m.name], models)
        for g in made.values():
            g.flush(store, rules)
        run.rows_out = healthy(out)
    return out
