"""Strict reading of semi-structured records held as VARIANT.

``Reader`` collects, beside each value, the first error in the order of reading, so that
one row that breaks a rule is a value of the error column and not a failed job."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def compile_path(path: str) -> str:
    """A dotted path ('a.b.0.c') as a variant path; numbers are array indexes."""
    if not path:
        raise ValueError("empty path")
    out = "$"
    for step in path.split("."):
        out += f"[{int(step)}]" if re.fullmatch(r"\d+", step) else "['" + step.replace("\\", "\\\\").replace("'", "\\'") + "']"
    return out


def get(v: Column, path: str) -> Column:
    """The part at path as VARIANT, null where missing; JSON null is not missing."""
    return F.try_variant_get(v, compile_path(path), "variant")


_KINDS = {"VOID": "NULL", "STRING": "STRING", "BOOLEAN": "BOOLEAN", "ARRAY": "ARRAY", "OBJECT": "OBJECT", **dict.fromkeys(("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "DECIMAL"), "NUMBER")}


def kind(v: Column) -> Column:
    """STRING, BOOLEAN, NUMBER, ARRAY, OBJECT or NULL; SQL null where missing."""
    known = F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in _KINDS.items())))  # folded to one literal
    return F.element_at(known, F.substring_index(F.substring_index(F.schema_of_variant(v), "<", 1), "(", 1))


def text(v: Column, path: str) -> Column:
    """The text at path; null where missing or of another kind."""
    return F.when(kind(get(v, path)) == "STRING", F.try_variant_get(v, compile_path(path), "string"))


def number(v: Column, path: str) -> Column:
    return F.when(kind(get(v, path)) == "NUMBER", F.try_variant_get(v, compile_path(path), "double"))


def flag(v: Column, path: str) -> Column:
    return F.when(kind(get(v, path)) == "BOOLEAN", F.try_variant_get(v, compile_path(path), "boolean"))


def items(v: Column, path: str) -> Column:
    """The elements at path as array<variant>; empty where it is no array."""
    part = get(v, path)
    return F.when(kind(part) == "ARRAY", part.cast("array<variant>")).otherwise(F.array().cast("array<variant>"))


class Reader:
    """Reads fields of one VARIANT column and keeps the first error."""

    def __init__(self, v: Column):
        self.v = v
        self.errors: list[Column] = []

    def _need(self, path: str, wanted: str, null_ok: bool = False) -> None:
        k = kind(get(self.v, path))
        tail = path.split(".")[-1]
        wrong = (k != wanted) & (k != "NULL") if null_ok else k != wanted
        self.errors.append(F.when(k.isNull(), F.lit(f'No entry at path "{tail}"')).when(wrong, F.lit(f'"{path}" is not {wanted.lower()}')))

    def text(self, path: str, null_ok: bool = False) -> Column:
        self._need(path, "STRING", null_ok)
        return text(self.v, path)

    def flag(self, path: str) -> Column:
        self._need(path, "BOOLEAN")
        return flag(self.v, path)

    def number(self, path: str) -> Column:
        self._need(path, "NUMBER")
        return number(self.v, path)

    def optional_text(self, path: str) -> Column:
        """Missing is null; another kind than text is an error."""
        k = kind(get(self.v, path))
        self.errors.append(F.when(k.isNotNull() & (k != "STRING"), F.lit(f'"{path}" is not string')))
        return text(self.v, path)

    def items(self, path: str) -> Column:
        self._need(path, "ARRAY")
        return items(self.v, path)

    def present(self, path: str) -> None:
        self.errors.append(F.when(get(self.v, path).isNull(), F.lit(f'No entry at path "{path.split(".")[-1]}"')))

    def check(self, broken: Column, message: str) -> None:
        self.errors.append(F.when(broken, F.lit(message)))

    def error(self) -> Column:
        unreadable = F.when(self.v.isNull(), F.lit("unreadable record"))
        return F.coalesce(unreadable, *self.errors)
