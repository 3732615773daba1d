"""Endpoints supplied by the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

# The variables an existing deployment already sets.
_NAMES = {
    "schema_registry": "SCHEMA_REGISTRY_SERVER",
    "kafka": "KAFKA_SERVER",
    "database_url": "DATABASE_SERVER",
    "database_user": "DATABASE_USERNAME",
    "database_password": "DATABASE_PASSWORD",
}


class MissingSetting(RuntimeError):
    """A required environment variable is not set."""


@dataclass(frozen=True)
class Settings:
    schema_registry: str
    kafka: str
    database_url: str
    database_user: str
    database_password: str

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        missing = sorted(name for name in _NAMES.values() if name not in env)
        if missing:
            raise MissingSetting(", ".join(missing) + " not set")
        return cls(**{field: env[name] for field, name in _NAMES.items()})
