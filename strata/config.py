"""Settings from YAML with environment overrides."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace
from functools import lru_cache
from pathlib import Path

DEMO_PEPPER = "demo-pepper"


@dataclass(frozen=True)
class Settings:
    environment: str = "local"
    root: str = "./lake"
    catalog: str = "main"
    pepper: str = ""
    small_cell_k: int = 11
    seed: int = 42

    def secret(self) -> str:
        """The pepper of pseudonymous keys; the demo value only counts locally."""
        if not self.pepper:
            raise RuntimeError("no pepper set")
        if self.pepper == DEMO_PEPPER and self.environment != "local":
            raise RuntimeError("the demo pepper is for local use only")
        return self.pepper

    def name(self, schema: str, table: str) -> str:
        return f"{self.catalog}.{schema}.{table}"


def shipped(name: str) -> Path:
    """A configuration file that comes with the package."""
    return Path(__file__).parent / "shipped" / name


@lru_cache(maxsize=1)
def load(path: str | Path = shipped("platform.yml"), prefix: str = "STRATA_") -> Settings:
    """Defaults, then the YAML file (as shipped, if none is named), then STRATA_<FIELD> variables. `load.cache_clear()` rereads."""
    values: dict = {}
    if path and Path(path).exists():
        import yaml

        values = yaml.safe_load(Path(path).read_text()) or {}
    out = Settings()
    for f in fields(Settings):
        raw = os.environ.get(prefix + f.name.upper(), values.get(f.name))
        if raw is not None:
            out = replace(out, **{f.name: type(getattr(out, f.name))(raw)})
    return out
