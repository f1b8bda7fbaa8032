"""Business keys and change digests as Column expressions.

Everything here is a built-in expression, so it stays inside whole-stage codegen and
two feeds that carry the same business key derive the same 32 bytes without a lookup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

# Part of the stored keys, never to change.
DELIMITER = "||"
NULL_TOKEN = "^^"
TRAILING_NULLS = r"(\|\|\^\^)+$"
KEY_BYTES = 32


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: str | Column, upper: bool = True) -> Column:
    """Canonical text of one component: cast, trim, upper-case, blank or NULL to the token."""
    text = F.trim(as_col(c).cast("string"))
    if upper:
        text = F.upper(text)
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(NULL_TOKEN))


def _scope(scope: str | None) -> list[Column]:
    if scope is None:
        return []
    token = scope.strip().upper()
    if not token:
        raise ValueError("a scope must be a non-blank name")
    if any(ch in token for ch in "'\\\x00"):
        raise ValueError(f"scope {scope!r} is not a system name")
    return [F.lit(token)]


def key_text(cols: Sequence[str | Column], scope: str | None = None) -> Column:
    """The text that ``hash_key`` digests; readable, for diagnostics."""
    if not cols:
        raise ValueError("a key needs at least one component")
    return F.concat_ws(DELIMITER, *_scope(scope), *[norm(c) for c in cols])


def digest(text: Column, algorithm: str = "sha2_256") -> Column:
    """Digest of a text. ``xxhash64`` is a BIGINT, the others are binary."""
    if algorithm == "sha2_256":
        return F.unhex(F.sha2(text, 256))
    if algorithm == "sha1":
        return F.unhex(F.sha1(text))
    if algorithm == "xxhash64":
        return F.xxhash64(text)
    raise ValueError(f"unsupported algorithm {algorithm!r}")


def hash_key(cols: Sequence[str | Column], scope: str | None = None,
             algorithm: str = "sha2_256") -> Column:
    """Key of a business object; ``scope`` names the key space of a federated source."""
    return digest(key_text(cols, scope), algorithm)


def parent_key(child_cols: Sequence[str | Column], hub_scope: str | None,
               literals: Sequence[str] = ()) -> Column:
    """A parent's key from the child's columns: the hub's literals lead, then the columns."""
    return hash_key([*[F.lit(v) for v in literals], *child_cols], hub_scope)


def link_key(parent_cols: Sequence[Sequence[str | Column]], txn_cols: Sequence[str | Column] = (),
             scope: str | None = None) -> Column:
    """Key of a relationship: its parents' components in order, then the transaction key.

    Digests the components, never the parents' digests, so a link-parented satellite can
    derive the same key from the same columns.
    """
    return hash_key([c for cols in parent_cols for c in cols] + list(txn_cols), scope)


def payload_text(cols: Sequence[str | Column]) -> Column:
    if not cols:
        raise ValueError("a payload needs at least one column")
    return F.regexp_replace(F.concat_ws(DELIMITER, *[norm(c, upper=False) for c in cols]), TRAILING_NULLS, "")


def hashdiff(cols: Sequence[str | Column]) -> Column:
    """Order-sensitive, case-preserving digest of a payload; appended NULLs do not change it."""
    return digest(payload_text(cols))


def hex_key(c: str | Column) -> Column:
    return F.lower(F.hex(as_col(c)))


def row_digest(cols: Sequence[str | Column], hk_cols: Sequence[str | Column] = ()) -> Column:
    """Content digest of a whole row; binary keys are read as hexadecimal text."""
    return F.sha2(payload_text([hex_key(k) for k in hk_cols] + list(cols)), 256)


def line_reference(cols: Sequence[str | Column]) -> Column:
    """Surrogate identity of a line that its source does not number; stays readable."""
    return F.sha2(F.concat_ws(DELIMITER, *[norm(c, upper=False) for c in cols]), 256)


def zero_key(width: int = KEY_BYTES) -> Column:
    return F.unhex(F.repeat(F.lit("00"), F.lit(width)))


SAFE_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def key_rules(cols: Sequence[str], mandatory: bool = True,
              schema: StructType | None = None) -> list[tuple[str, Column]]:
    """Rules a key component must meet: present, no delimiter inside, not the null token.

    With a ``schema``, numbers, dates, clocks and booleans are only asked to be present: they can hold neither a
    delimiter nor the token. Components of all other types, binary ones too, are read as text.
    """
    rules, sure = [], F.lit(True)
    for name in cols:
        textual = schema is None or not isinstance(schema[name].dataType, SAFE_TYPES)
        text = F.col(name).cast("string")
        if mandatory:
            there = F.col(name).isNotNull()
            rules.append((f"key_present_{name}", there & (F.trim(text) != "") if textual else there))
        rules.append((f"key_no_delimiter_{name}",
                      F.coalesce(F.instr(text, DELIMITER), F.lit(0)) == 0 if textual else sure))
        rules.append((f"key_not_null_token_{name}",
                      F.coalesce(F.trim(text) != NULL_TOKEN, sure) if textual else sure))
    return rules
