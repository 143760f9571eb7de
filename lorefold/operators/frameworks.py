"""Framework patterns as data: read from settings, repository over project, and met in sources."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scoring import contained


def _patterns(setting) -> list[dict]:
    try:
        raw = json.loads(setting) if isinstance(setting, str) else None
    except ValueError:
        raw = None
    out = []
    for framework, patterns in raw.items() if isinstance(raw, dict) else ():
        for pattern, role in patterns.items() if isinstance(patterns, dict) else ():
            if isinstance(role, str) and framework.strip() and pattern.strip() and role.strip():
                out.append({"framework": framework.strip(), "pattern": pattern.strip(), "role": role.strip()})
    return out


def parse_patterns(settings: DataFrame, column: str = "settings") -> DataFrame:
    """settings' other columns with (framework, pattern, role) of a JSON object of frameworks, each an object of pattern to role.

    Names, patterns and roles are trimmed; blank ones, and what isn't an object or a text, are left out.
    """

    @F.pandas_udf("array<struct<framework:string,pattern:string,role:string>>")
    def parsed(batch: pd.Series) -> pd.Series:
        return batch.map(_patterns)

    others = [c for c in settings.columns if c != column]
    return settings.select(*others, F.explode(parsed(F.col(column))).alias("p")).select(*others, "p.*")


def merge_patterns(project: DataFrame, repository: DataFrame) -> DataFrame:
    """Patterns of both, the repository's role where both have a framework's pattern."""
    both = project.select("framework", "pattern", "role", F.lit(0).alias("_o")).unionByName(repository.select("framework", "pattern", "role", F.lit(1).alias("_o")))
    return both.groupBy("framework", "pattern").agg(F.max_by("role", F.struct("_o", "role")).alias("role"))


def custom_nodes(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """(id, kind, name, file_path, qualified_name, framework, role, pattern): a node for each role of a framework whose pattern a file holds.

    Several patterns of one role give one node, that of the last pattern.
    """
    named = patterns.select("framework", F.col("pattern").alias("_pattern"), "role")
    met = contained(files.select("path", "text"), "text", named, "_pattern")
    package = F.regexp_extract("text", r"package\s+([\w.]+)\s*;", 1)
    rows = met.select(F.concat_ws("::", "path", "framework", "role").alias("id"), F.lit("class").alias("kind"), F.col("role").alias("name"), F.col("path").alias("file_path"), F.concat_ws(".", F.nullif(package, F.lit("")), "role").alias("qualified_name"), "framework", "role", F.col("_pattern").alias("pattern"))
    return rows.groupBy("id").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "id"]), "pattern").alias("r")).select("id", "r.*")
