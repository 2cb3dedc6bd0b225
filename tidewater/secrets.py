"""Secret references in connector options: ``password_secret: env:DB_PASSWORD`` or
``file:/run/secrets/db_password`` (a mounted secret file). The plain value never has to
sit in a spec file."""
from __future__ import annotations

import os

from .errors import SpecError

# Option names that hold a secret reference, and the option each fills.
SECRET_OPTIONS = {"password_secret": "password", "sfPassword_secret": "sfPassword"}


def resolve(ref: str) -> str:
    kind, _, name = str(ref).partition(":")
    if kind == "env":
        if name not in os.environ:
            raise SpecError(f"secret environment variable {name!r} is not set")
        return os.environ[name]
    if kind == "file":
        with open(name, encoding="utf-8") as fh:
            return fh.read().strip()
    raise SpecError(f"unsupported secret reference {ref!r} (use env:NAME or file:/path)")


def resolve_options(options: dict) -> dict:
    """Copy of ``options`` with every ``*_secret`` reference replaced by its value."""
    out = dict(options)
    for ref_key, key in SECRET_OPTIONS.items():
        if ref_key in out:
            out[key] = resolve(out.pop(ref_key))
    return out
