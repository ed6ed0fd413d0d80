"""Plug-in points for model calls, run once per Arrow batch inside the executors, and deterministic stand-ins for tests.

A client is any picklable object with the method named in its protocol. Errors become rows, never task failures, so a
retried task repeats no more calls than it must; write results down before folding them.
"""

from __future__ import annotations

import hashlib
import json
import threading
import time
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.session import bound_batches

GRAPH = "nodes array<struct<id:string,type:string,properties:map<string,string>>>, relationships array<struct<source:string,target:string,type:string,properties:map<string,string>>>"
ATTEMPTS, RATE_WAIT, CONNECTION_WAIT = 5, 65.0, 30.0
_CONNECTION = ("connection", "refused", "reset", "timed out", "timeout", "unreachable")


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class Completer(Protocol):
    def complete(self, prompt: str) -> str: ...


class RawCompleter(Completer, Protocol):
    """A client that can also be asked without a reply schema; that is tried when the schema's call fails."""

    def complete_raw(self, prompt: str) -> str: ...


class TimedOut(Exception):
    """A call that took longer than it may."""


def within(seconds: float | None, call: Callable[[], str]) -> str:
    """The call's reply, or TimedOut once ``seconds`` of wall-clock time are over, whatever the call is waiting for.

    A call that is given up goes on in a thread of its own, which no longer matters to anyone and ends with the process.
    """
    if seconds is None:
        return call()
    got: dict[str, object] = {}

    def run() -> None:
        try:
            got["reply"] = call()
        except BaseException as e:  # handed on to the caller's thread
            got["error"] = e

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    thread.join(seconds)
    if "error" in got:
        raise got["error"]
    if "reply" not in got:
        raise TimedOut(f"no reply within {seconds} s")
    return got["reply"]


def complete_or_raw(client, prompt: str, seconds: float | None = None) -> str:
    """The client's reply; if that call fails, its raw reply, if it has any. Each call has the whole time."""
    try:
        return within(seconds, lambda: client.complete(prompt))
    except Exception:
        if not hasattr(client, "complete_raw"):
            raise
        return within(seconds, lambda: client.complete_raw(prompt))


class PermanentLimit(Exception):
    """A limit that waiting doesn't lift."""


def with_retries(call: Callable[[], str], attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None, int]:
    """(reply, error, attempts used). Rate limits wait longer than lost connections; permanent limits aren't retried."""
    error = None
    for n in range(1, attempts + 1):
        try:
            return call(), None, n
        except PermanentLimit as e:
            return None, str(e), n
        except Exception as e:  # a client may raise anything
            error = f"{type(e).__name__}: {e}"
            low = error.lower()
            if n < attempts:
                sleep(RATE_WAIT if "429" in low or "rate limit" in low else CONNECTION_WAIT if any(w in low for w in _CONNECTION) else 0.0)
    return None, error, attempts


def embed(rows: DataFrame, client: Embedder, key: str, text: str, size: int | None = None) -> DataFrame:
    """(key, embedding) of each row's text; a vector of another size than ``size`` is an error."""
    kind = rows.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            vectors = client.embed(f["text"].tolist())
            wrong = [len(v) for v in vectors if size is not None and len(v) != size]
            if wrong:
                raise ValueError(f"an embedding has {wrong[0]} components, not {size}")
            yield pd.DataFrame({key: f["key"], "embedding": vectors})

    return rows.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(run, f"`{key}` {kind}, embedding array<float>")


def embed_missing(descriptions: DataFrame, client: Embedder, allowed, with_topic: bool = False, force: bool = False, size: int | None = None) -> DataFrame:
    """Descriptions (id, text, topic, type, embedding) with vectors for those of an allowed type that lack one."""
    from strataloom.functions.text import strip

    todo = descriptions.where(F.col("type").isin(*allowed) & (strip(F.coalesce("text", F.lit(""))) != ""))
    todo = todo if force else todo.where("embedding is null")
    said = F.concat("topic", F.lit(": "), "text") if with_topic else F.col("text")
    new = embed(todo.select("id", F.coalesce(said, "text").alias("said")), client, "id", "said", size).withColumnRenamed("embedding", "__new")
    return descriptions.join(new, "id", "left").withColumn("embedding", F.coalesce("__new", "embedding")).drop("__new")


def ask(rows: DataFrame, client: Completer, key: str, prompt: str, attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep, seconds: float | None = None) -> DataFrame:
    """(key, reply, error, attempts) of a prompt per row. Partitions bound how many calls run at once.

    ``seconds`` bounds each call by the clock; a client with complete_raw is asked again that way when a call fails. Batches
    are bounded in bytes as well, since prompts may be long.
    """
    bound_batches(rows.sparkSession)
    kind = rows.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [with_retries(lambda p=p: complete_or_raw(client, p, seconds), attempts, sleep) for p in f["prompt"]]
            yield pd.DataFrame({key: f["key"], "reply": [g[0] for g in got], "error": [g[1] for g in got], "attempts": [g[2] for g in got]})

    return rows.select(F.col(key).alias("key"), F.col(prompt).alias("prompt")).mapInPandas(run, f"`{key}` {kind}, reply string, error string, attempts int")


# --- prompts: what each call must be told, in our words ---------------------------------------------------------------------


def extraction_prompt(text, source_name, source_format, paper_only: bool = False):
    from strataloom import ontology as o

    types = ", ".join(o.PAPER_TYPES if paper_only else (*o.PAPER_TYPES, *o.MEETING_TYPES))
    head = (
        "Read the passage and return JSON with the keys nodes and relationships. Name one to three core Topics, give each exactly one Type out of: "
        + types + ". Link Topics with relates_to only where the passage states the link. Add one Source whose id is the given name, verbatim, and a Description per Topic and Type with "
        "a concrete detail and the properties text, topicName and typeName.\n"
    )
    return F.concat(F.lit(head), F.lit("Source: "), source_name, F.lit("\nFormat: "), source_format, F.lit("\nPassage:\n"), text)


def nli_prompt(text_a, text_b):
    head = "Do the two statements contradict each other? Answer in JSON with label (contradiction, entailment, neutral or unclear), confidence from 0 to 1, and rationale. That they come from different studies does not make them neutral.\n"
    return F.concat(F.lit(head), F.lit("A: "), text_a, F.lit("\nB: "), text_b)


def supersession_prompt(older, newer, year_older, year_newer, context):
    from strataloom import ontology as o

    head = "Does the newer statement replace the older one? Answer in JSON with decision (yes or no), basis, reason and confidence. A yes needs one of these bases: " + ", ".join(o.SUPERSESSION_BASES) + ". A later year alone is no basis, and weaker evidence replaces nothing.\n"
    return F.concat(F.lit(head), F.lit("Older ("), year_older, F.lit("): "), older, F.lit("\nNewer ("), year_newer, F.lit("): "), newer, F.lit("\nContext: "), context)


def cluster_prompt(block):
    head = "First decide whether the statements oppose each other at all; if not, answer not_a_conflict. If they do, say why: scope_difference (with scope_conditions), known_controversy, unresolved or insufficient_evidence. Answer in JSON with resolution_type, summary, scope_conditions, confidence (always), evidence_used and positions.\n"
    return F.concat(F.lit(head), block)


def participants_block(participants):
    """Text of an array of structs (id, source, topic, text, context array)."""
    one = lambda p, i: F.concat(
        F.lit("["), (i + 1).cast("string"), F.lit("] "), p["id"], F.lit(" (source "), F.coalesce(p["source"], F.lit("unknown")), F.lit(", topic "), F.coalesce(p["topic"], F.lit("")), F.lit("): "), p["text"],
        F.when(F.size(p["context"]) > 0, F.concat(F.lit("\n    context: "), F.array_join(p["context"], " | "))).otherwise(F.lit("")),
    )
    return F.array_join(F.transform(participants, one), "\n")


# --- clients by name ----------------------------------------------------------------------------------------------------


def endpoint(settings: Mapping[str, str], purpose: str) -> str | None:
    """Where to call for a purpose: its own address, else the shared one, else none; without a slash at the end."""
    found = settings.get(f"{purpose}_url") or settings.get("url")
    return found.rstrip("/") if found else None


class HttpClient:
    """A service that takes and gives JSON over HTTP. Requests and replies are shaped by the functions given by name, so
    that the client can be sent to executors."""

    def __init__(self, kind: str, url: str, model: str, headers: Mapping[str, str] | None = None, seconds: float = 120.0):
        self.kind, self.url, self.model, self.headers, self.seconds = kind, url, model, dict(headers or {}), seconds

    def _post(self, path: str, body: dict) -> dict:
        data = json.dumps(body).encode()
        request = urllib.request.Request(self.url + path, data, {"Content-Type": "application/json", **self.headers})
        with urllib.request.urlopen(request, timeout=self.seconds) as reply:
            return json.loads(reply.read())

    def complete(self, prompt: str) -> str:
        return self._said(prompt, True)

    def complete_raw(self, prompt: str) -> str:
        return self._said(prompt, False)

    def _said(self, prompt: str, as_json: bool) -> str:
        if self.kind == "ollama":
            got = self._post("/api/generate", {"model": self.model, "prompt": prompt, "stream": False, **({"format": "json"} if as_json else {})})
            return got["response"]
        if self.kind == "google":
            body = {"contents": [{"parts": [{"text": prompt}]}], **({"generationConfig": {"responseMimeType": "application/json"}} if as_json else {})}
            return self._post(f"/models/{self.model}:generateContent", body)["candidates"][0]["content"]["parts"][0]["text"]
        body = {"model": self.model, "messages": [{"role": "user", "content": prompt}], **({"response_format": {"type": "json_object"}} if as_json else {})}
        return self._post("/chat/completions", body)["choices"][0]["message"]["content"]

    def embed(self, texts: list[str]) -> list[list[float]]:
        if self.kind == "ollama":
            return self._post("/api/embed", {"model": self.model, "input": texts})["embeddings"]
        rows = self._post("/embeddings", {"model": self.model, "input": texts})["data"]
        return [r["embedding"] for r in sorted(rows, key=lambda r: r["index"])]


class LocalTransformer:
    """A model of the transformers library, loaded once in each worker."""

    def __init__(self, model: str):
        self.model, self._loaded = model, {}

    def __getstate__(self):
        return {"model": self.model, "_loaded": {}}

    def _of(self, task: str):
        if task not in self._loaded:
            from transformers import pipeline  # absent unless the user has it

            self._loaded[task] = pipeline(task, model=self.model)
        return self._loaded[task]

    def complete(self, prompt: str) -> str:
        return self._of("text-generation")(prompt, return_full_text=False)[0]["generated_text"]

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [[sum(column) / len(column) for column in zip(*tokens[0], strict=True)] for tokens in self._of("feature-extraction")(texts)]


#: Services by name, with the header that carries a key and the address if none is given.
_SERVICES = {
    "ollama": (None, "http://localhost:11434"), "openai": ("Authorization", "https://api.openai.com/v1"), "azure-openai": ("api-key", None),
    "google": ("x-goog-api-key", "https://generativelanguage.googleapis.com/v1beta"),
}
_COMPLETERS, _EMBEDDERS = ("ollama", "openai", "azure-openai", "google", "trf"), ("ollama", "openai", "azure-openai", "trf")


def _client(settings: Mapping[str, str], purpose: str, known: tuple[str, ...]):
    name = (settings.get(f"{purpose}_provider") or settings.get("provider") or "").strip().lower()
    model = settings.get(f"{purpose}_model") or settings.get("model")
    if name not in known or not model:
        return None
    if name == "trf":
        return LocalTransformer(model)
    header, default = _SERVICES[name]
    url, key = endpoint(settings, purpose) or default, settings.get(f"{purpose}_key") or settings.get("key")
    if not url:
        raise ValueError(f"{name} needs an address")
    headers = {header: f"Bearer {key}" if header == "Authorization" else key} if header and key else {}
    return HttpClient(name, url, model, headers)


def completer(settings: Mapping[str, str], purpose: str = "llm") -> Completer | None:
    """The client that settings (provider, model, url, key, each also with the purpose before it) name; None if unknown."""
    return _client(settings, purpose, _COMPLETERS)


def embedder(settings: Mapping[str, str], purpose: str = "embedding") -> Embedder | None:
    return _client(settings, purpose, _EMBEDDERS)


# --- stand-ins ----------------------------------------------------------------------------------------------------------


class HashEmbedder:
    """Vectors made of a hash of the text."""

    def __init__(self, size: int = 16):
        self.size = size

    def embed(self, texts):
        return [[b / 127.5 - 1 for b in hashlib.shake_128(t.encode()).digest(self.size)] for t in texts]


class ScriptedCompleter:
    """Replies by the first key that a prompt contains, after ``failures`` errors per prompt; each call may be noted in a
    file, since every task has a client of its own."""

    def __init__(self, replies: dict[str, object], failures: int = 0, error: str = "connection reset", log: str | None = None):
        self.replies, self.failures, self.error, self.log, self.seen = replies, failures, error, log, {}

    def complete(self, prompt):
        if self.log:
            with open(self.log, "a") as f:
                f.write("x")
        self.seen[prompt] = self.seen.get(prompt, 0) + 1
        if self.seen[prompt] <= self.failures:
            raise RuntimeError(self.error)
        for key, reply in self.replies.items():
            if key in prompt:
                return reply if isinstance(reply, str) else json.dumps(reply)
        return "{}"
