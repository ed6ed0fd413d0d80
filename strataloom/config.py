"""Settings, with the defaults of the ontology module and overrides from the environment (STRATALOOM_<NAME>)."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

from strataloom import ontology as o


@dataclass(frozen=True)
class Settings:
    knn: int = o.KNN
    similarity_floor: float | None = o.SIMILARITY_FLOOR
    embed_with_topic: bool = False
    short_text: int = o.SHORT_TEXT
    reject_confidence: float = o.REJECT_CONFIDENCE
    cluster_most: int = o.CLUSTER_MOST
    topic_similarity: float = o.TOPIC_SIMILARITY
    source_cap: int = o.SOURCE_CAP
    speech_chars: int = o.SPEECH_CHARS
    sweep_seconds: int = 900
    blocking_version: str = o.BLOCKING_VERSION
    gate_version: str = o.GATE_VERSION
    classification_version: str = o.CLASSIFICATION_VERSION

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Numbers that don't parse are an error; an empty similarity floor means none; a sweep of 0 hardly ever happens."""
        env = os.environ if env is None else env
        given = {}
        for f in fields(cls):
            raw = env.get(f"STRATALOOM_{f.name.upper()}")
            if raw is None:
                continue
            default = f.default
            if f.name == "similarity_floor" and not raw.strip():
                given[f.name] = None
            elif isinstance(default, bool):
                given[f.name] = raw.strip().lower() in ("1", "true", "yes", "on")
            else:
                given[f.name] = type(default)(raw)
        if given.get("sweep_seconds") == 0:
            given["sweep_seconds"] = 10**9
        return cls(**given)
