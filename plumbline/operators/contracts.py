"""Artifacts and their contracts: versions, hashes, ids and schema checks."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from plumbline.functions.canonical import content_hash, map_hash

RUN_ID, PROJECT_ID = r"^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$", r"^[a-z0-9][a-z0-9-]{0,63}$"
UNSUPPORTED = "SCHEMA_VERSION_UNSUPPORTED_BY_CONSUMER"


def semver(version: Column) -> Column:
    """(major, minor, patch) as a struct that compares; null if it isn't one."""
    part = lambda k: F.regexp_extract(version, r"^(\d+)\.(\d+)\.(\d+)$", k).try_cast("int")
    return F.when(part(1).isNotNull(), F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch")))


def latest(catalog: DataFrame) -> DataFrame:
    """The latest version of each schema id."""
    return catalog.groupBy("schema_id").agg(F.max_by("schema_version", semver(F.col("schema_version"))).alias("schema_version"))


def catalog_faults(files: DataFrame) -> DataFrame:
    """files: path, schema_id, schema_version, doc_id.  Names that don't say what
    is in the file, and pairs or ids that occur twice."""
    name = r"/?([a-z_]+)/v(\d+)/([a-z_]+)-(\d+\.\d+\.\d+)\.schema\.json$"
    g = lambda k: F.regexp_extract("path", name, k)
    wrong = (g(1) == "") | (g(1) != g(3)) | (g(1) != F.col("schema_id")) | (g(4) != F.col("schema_version")) | (g(2) != F.substring_index(g(4), ".", 1))
    twice = lambda *c: F.count("*").over(Window.partitionBy(*c)) > 1
    out = files.withColumn("fault", F.when(wrong, "NAME_MISMATCH").when(twice("schema_id", "schema_version"), "DUPLICATE_VERSION").when(twice("doc_id"), "DUPLICATE_ID"))
    return out.where("fault is not null").select("path", "fault")


def consumer_rejections(documents: DataFrame, catalog: DataFrame) -> DataFrame:
    """documents: doc, schema_id, schema_version, consumer_version, n_errors (of the
    document under its own version).  Why a consumer can't read a document."""
    known = catalog.select("schema_id", F.col("schema_version").alias("consumer_version"), F.lit(True).alias("known")).distinct()
    d = documents.join(known, ["schema_id", "consumer_version"], "left")
    newer = semver(F.col("schema_version")) > semver(F.col("consumer_version"))
    same = F.col("schema_version") == F.col("consumer_version")
    detail = F.when(F.col("known").isNull(), "unknown version").when(newer, "newer document").when(same & (F.col("n_errors") > 0), "invalid")
    detail = F.when(F.col("schema_id").isNotNull() & F.col("schema_version").isNotNull(), detail)
    return d.select("doc", detail.alias("detail"), F.when(detail.isNotNull(), F.lit(UNSUPPORTED)).alias("code"))


def with_hash(documents: DataFrame) -> DataFrame:
    """documents: json.  Adds the computed hash and whether the stated one agrees."""
    out = documents.withColumn("computed", content_hash("json"))
    return out.withColumn("intact", F.coalesce(F.get_json_object("json", "$.content_hash") == F.col("computed"), F.lit(False)))


def tree_hashes(files: DataFrame, *by: str) -> DataFrame:
    """files: path, size, sha256.  One hash of each tree, over its sorted paths."""
    entry = F.concat(F.lit('{"path":'), F.to_json(F.array("path")).substr(F.lit(2), F.length(F.to_json(F.array("path"))) - 2), F.lit(',"size":'), F.col("size").cast("string"), F.lit(',"sha256":"'), F.col("sha256"), F.lit('"}'))
    lists = files.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("path", entry.alias("e")))).alias("l"))
    text = F.concat(F.lit("["), F.array_join(F.transform("l", lambda x: x["e"]), ","), F.lit("]"))
    return lists.select(*by, map_hash(text).alias("tree_hash"))


def compare_hashes(declared: DataFrame, actual: DataFrame, *on: str) -> DataFrame:
    """Files that are missing, unexpected or different."""
    j = declared.select(*on, F.col("sha256").alias("declared")).join(actual.select(*on, F.col("sha256").alias("actual")), list(on), "full")
    state = F.when(F.col("actual").isNull(), "missing").when(F.col("declared").isNull(), "unexpected").when(F.col("declared") != F.col("actual"), "different")
    return j.withColumn("state", state).where("state is not null").select(*on, "state")


def safe_path(path: Column) -> Column:
    """Relative, without empty, dot or parent parts, drives or backslashes."""
    return F.coalesce(~path.rlike(r"^/|:|\\|(^|/)(\.\.?)?(/|$)") & (path != ""), F.lit(False))


def valid_run_id(value: Column) -> Column:
    return F.coalesce(value.rlike(RUN_ID), F.lit(False))


def artifact(payloads: DataFrame, schema_id: str, version: str, agent: str) -> DataFrame:
    """payloads: plan_id, run_id, status, payload (JSON), errors (JSON list), inputs
    (JSON list), created_at.  One enveloped JSON document each, with its hash."""
    doc = F.concat(
        *[F.lit(f'{{"schema_id":"{schema_id}","schema_version":"{version}","producer":{{"agent":"{agent}","provider":null,"model":null,"effort":null}},"artifact_id":"{schema_id}-'), F.col("run_id"), F.lit('","project_id":"'), F.col("plan_id"), F.lit('","run_id":"'), F.col("run_id"), F.lit('","created_at":"'), F.col("created_at"), F.lit('","status":"'), F.col("status"), F.lit('","inputs":'), F.col("inputs"), F.lit(',"errors":'), F.col("errors"), F.lit(',"payload":'), F.col("payload"), F.lit("}")]
    )
    out = payloads.withColumn("body", doc).withColumn("content_hash", content_hash("body"))
    return out.select("plan_id", "run_id", F.concat(F.expr("substring(body, 1, length(body) - 1)"), F.lit(',"content_hash":"'), F.col("content_hash"), F.lit('"}')).alias("json"), "content_hash")


_KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value, kind: str) -> bool:
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "integer":
        return not isinstance(value, bool) and (isinstance(value, int) or (isinstance(value, float) and value.is_integer()))
    return isinstance(value, _KINDS[kind])


def schema_errors(value, schema: dict, root: dict, registry: dict, path: str = "$") -> list[tuple[str, str]]:
    """(path, keyword) of everything in which a value breaks a schema: the subset
    of the 2020-12 vocabulary that the contracts use; formats aren't asserted."""
    out: list[tuple[str, str]] = []
    if "$ref" in schema:
        uri, _, pointer = schema["$ref"].partition("#")
        target = top = registry[uri] if uri else root
        for part in filter(None, pointer.split("/")):
            target = target[part]
        out += schema_errors(value, target, top, registry, path)
    fail = lambda keyword: out.append((path, keyword))
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        fail("type")
    same = lambda a, b: a == b and isinstance(a, bool) == isinstance(b, bool)
    if "const" in schema and not same(value, schema["const"]):
        fail("const")
    if "enum" in schema and not any(same(value, e) for e in schema["enum"]):
        fail("enum")
    if isinstance(value, str):
        if "pattern" in schema and not re.search(schema["pattern"], value):
            fail("pattern")
        if len(value) < schema.get("minLength", 0):
            fail("minLength")
    if _is(value, "number"):
        for keyword, bad in (("minimum", lambda m: value < m), ("maximum", lambda m: value > m), ("exclusiveMinimum", lambda m: value <= m), ("exclusiveMaximum", lambda m: value >= m), ("multipleOf", lambda m: (value / m) % 1 != 0)):
            if keyword in schema and bad(schema[keyword]):
                fail(keyword)
    if isinstance(value, list):
        if len(value) < schema.get("minItems", 0):
            fail("minItems")
        if len(value) > schema.get("maxItems", len(value)):
            fail("maxItems")
        if schema.get("uniqueItems") and len({json.dumps(v, sort_keys=True) for v in value}) < len(value):
            fail("uniqueItems")
        before = schema.get("prefixItems", [])
        for i, v in enumerate(value):
            inner = before[i] if i < len(before) else schema.get("items")
            if isinstance(inner, dict):
                out += schema_errors(v, inner, root, registry, f"{path}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [(path, "required") for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                out += schema_errors(v, known[k], root, registry, f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                fail("additionalProperties")
            elif isinstance(schema.get("additionalProperties"), dict):
                out += schema_errors(v, schema["additionalProperties"], root, registry, f"{path}.{k}")
    for part in schema.get("allOf", []):
        out += schema_errors(value, part, root, registry, path)
    if "if" in schema:
        branch = "else" if schema_errors(value, schema["if"], root, registry, path) else "then"
        if branch in schema:
            out += schema_errors(value, schema[branch], root, registry, path)
    return out


def validate_documents(documents: DataFrame, catalog: dict[tuple[str, str], dict]) -> DataFrame:
    """documents: doc, json.  Adds `errors`: path and keyword of each, sorted by
    path.  The catalog is fixed and small, and travels with the code."""
    registry = {s["$id"]: s for s in catalog.values() if "$id" in s}

    @F.pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                doc = json.loads(text)
                schema = catalog.get((doc.get("schema_id"), doc.get("schema_version")))
            except (TypeError, ValueError, AttributeError):
                return '[{"path":"$","keyword":"json"}]'
            if schema is None:
                return '[{"path":"$","keyword":"unknown schema"}]'
            return json.dumps([{"path": p, "keyword": k} for p, k in sorted(schema_errors(doc, schema, schema, registry))])

        return texts.map(one)

    return documents.withColumn("errors", F.from_json(run("json"), "array<struct<path: string, keyword: string>>"))


def quality(spark: SparkSession, inventory: DataFrame) -> DataFrame:
    """inventory: project, kind, m_per_px, units.  A raster's scale is known if it
    is given, a drawing's if its units are known; unknown scale blocks."""
    raster = F.col("kind").isin("png", "jpg", "pdf")
    known = F.when(raster, F.col("m_per_px") > 0).otherwise(F.col("units").isin("mm", "cm", "m"))
    known = F.coalesce(known, F.lit(False))
    return inventory.select("project", known.alias("scale_known"), F.when(known, "complete").otherwise("partial").alias("status"), F.when(~known, F.lit("INPUT_SCALE_UNKNOWN")).alias("blocker"))
