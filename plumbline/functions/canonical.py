"""Canonical JSON (compact, keys sorted, no escapes beyond JSON's) and hashes of it.

Spark's to_json neither sorts keys nor prints numbers this way, so this is an
Arrow UDF over JSON text, batch by batch."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def canonical_text(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def sha256_text(text: str) -> str:
    return "sha256:" + hashlib.sha256(text.encode("utf-8")).hexdigest()


def document_hash(document: dict) -> str:
    """The hash of a document without its own content_hash."""
    return sha256_text(canonical_text({k: v for k, v in document.items() if k != "content_hash"}))


@F.pandas_udf(StringType())
def content_hash(documents: pd.Series) -> pd.Series:
    """Hash of each JSON document; null where the text isn't a JSON object."""

    def one(text):
        try:
            value = json.loads(text)
        except (TypeError, ValueError):
            return None
        return document_hash(value) if isinstance(value, dict) else None

    return documents.map(one)


@F.pandas_udf(StringType())
def _projection_hash(rows: pd.DataFrame) -> pd.Series:
    def plain(v):
        return [plain(x) for x in v] if hasattr(v, "__len__") and not isinstance(v, (str, dict)) else v

    def one(rooms, walls, openings):
        lists = [[o["a"], o["b"], plain(o["c"]), o["d"]] for o in (openings if openings is not None else [])]
        doc = {"units": "m", "rooms": plain(rooms if rooms is not None else []), "walls": plain(walls if walls is not None else []), "openings": lists}
        return sha256_text(canonical_text(json.loads(json.dumps(doc, default=float))))

    return pd.Series([one(*r) for r in zip(rows["rooms"], rows["walls"], rows["openings"])], dtype="object")


def canonical_hash(projection: Column) -> Column:
    return _projection_hash(projection)


@F.pandas_udf(StringType())
def map_hash(names: pd.Series) -> pd.Series:
    """Hash of the canonical JSON of a JSON text of any kind."""
    return names.map(lambda t: None if t is None else sha256_text(canonical_text(json.loads(t))))
