"""Settings of model runs: a file's value counts before the environment's, that before the default; keys are never written."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, fields, replace
from pathlib import Path

PREFIX = "CLIPLAKE_"


@dataclass(frozen=True)
class Pricing:
    """US dollars for a million tokens; None: unknown."""

    input_per_mtok_usd: float | None = None
    output_per_mtok_usd: float | None = None


@dataclass(frozen=True)
class RunConfig:
    """A model run; the two-pass fields are not used by a single pass."""

    provider: str = "provider"
    model_id: str = "model"
    synthesis_model_id: str | None = None
    api_key: str | None = None
    prompt_version: str = "v0_1"
    synthesis_prompt_version: str = "v0_1"
    prompt: str = "Describe each shot as JSON.\n{shot_list}"
    synthesis_prompt: str = "Describe the whole video as JSON.\n{source_metadata}\n{media_facts}\n{shot_list}\n{shot_analyses}"
    batch_size: int = 1
    temperature: float = 0.0
    top_p: float | None = None
    max_output_tokens: int | None = None
    min_gap_seconds: float = 30.0
    lanes: int = 8
    ledger_batch: int = 1000
    max_attempts: int = 6
    input_per_mtok_usd: float | None = None
    output_per_mtok_usd: float | None = None

    @property
    def synthesis_model(self) -> str:
        return self.synthesis_model_id or self.model_id

    @property
    def pricing(self) -> Pricing:
        return Pricing(self.input_per_mtok_usd, self.output_per_mtok_usd)

    def to_dict(self) -> dict:
        """All fields but those with `key` in their name."""
        return {f.name: getattr(self, f.name) for f in fields(self) if "key" not in f.name}

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), indent=2, sort_keys=True)

    def generation_settings(self) -> dict:
        """What goes with a request; optional settings only if set."""
        more = {k: getattr(self, k) for k in ("top_p", "max_output_tokens") if getattr(self, k) is not None}
        return {"temperature": self.temperature, "response_mime_type": "application/json", **more}


def _typed(kind: str, value):
    if value is None or not isinstance(value, str):
        return value
    return float(value) if "float" in kind else int(value) if "int" in kind else value


def load(path: str | None = None, env: dict[str, str] | None = None, default: RunConfig = RunConfig()) -> RunConfig:
    """The settings of a JSON file, of CLIPLAKE_<NAME> in the environment, and the defaults, in that order. Unknown names in the file are an error."""
    env = os.environ if env is None else env
    given: dict = {}
    if path is not None:
        if not Path(path).is_file():
            raise FileNotFoundError(f"config not found: {path}")
        given = json.loads(Path(path).read_text())
    names = {f.name: str(f.type) for f in fields(RunConfig)}
    if unknown := sorted(set(given) - set(names)):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    found = {n: env[PREFIX + n.upper()] for n in names if PREFIX + n.upper() in env} | given
    config = replace(default, **{n: _typed(names[n], v) for n, v in found.items()})
    if config.batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    return config
