"""Rule tables: routing, types, functions, reserved words."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These tables must hold exactly these entries for results to match.

# command -> (target, reason) of the planning profile
PLANNING_ROUTES = {
    "ODPS_SQL": ("Dataform .sqlx", "In-warehouse SQL -> BigQuery via Dataform"),
    "ODPS_SPARK": ("Dataproc (PySpark)", "Genuinely distributed Spark only"),
    "PYODPS": ("TRIAGE", "PyODPS -> push SQL down to Dataform; else Dataflow/PythonOperator"),
    "PYTHON": ("TRIAGE", "Light -> PythonOperator; data-heavy -> Dataflow"),
    "DIDE_SHELL": ("TRIAGE", "Shell script -> BashOperator or PythonOperator; audit each before porting"),
    "VIRTUAL": ("EmptyOperator", "No-op / flow control"),
    "DIDE_DO_WHILE": ("Branching / loop operators", "Control flow in Airflow"),
    "DIDE_FOR_EACH": ("Branching / loop operators", "Control flow in Airflow"),
    "DATA_INTEGRATION": ("BigQuery DTS / Datastream / Dataflow", "Source->sink sync, not SQL"),
    "DI": ("BigQuery DTS / Datastream / Dataflow", "Source->sink sync, not SQL"),
    "MYSQL": ("Datastream / Dataflow", "DB ops -> BigQuery via sync pipeline"),
    "POSTGRESQL": ("Datastream / Dataflow", "DB ops -> BigQuery via sync pipeline"),
}
PLANNING_DEFAULT = ("PythonOperator (review)", "Unknown command -> human review")

# command -> reason of commands that always need a review
REVIEW_COMMANDS = {
    "ODPS_SPARK": "MaxCompute Spark — needs manual Composer/Dataflow rewrite",
    "DIDE_SHELL": "Shell script -> BashOperator or PythonOperator; audit each",
    "DIDE_DO_WHILE": "Loop construct — no direct GCP equivalent",
    "DIDE_FOR_EACH": "Loop construct — no direct GCP equivalent",
    "DATA_INTEGRATION": "Offline sync (DATAX) — Dataflow / load job",
    "DI": "Data Integration — Dataflow / load job",
    "MYSQL": "External MySQL connector — Composer task",
    "POSTGRESQL": "External PostgreSQL connector — Composer task",
}
REVIEW_DEFAULT = "Unknown command -> human review"

SQL_TARGET = "Dataform .sqlx"
HEAVY_TARGET = "Dataflow (Beam)"
LIGHT_TARGET = "PythonOperator"
EMPTY_TARGET = "EmptyOperator"
REVIEW_TARGET = "TRIAGE"
SQL_REASON = "PyODPS that is really SQL -> push down to BigQuery SQL"
HEAVY_REASON = "Data-heavy Python -> keep off the Composer worker"
HEAVY_REASON_BUILD = "Data-heavy Python -> keep off the Composer worker (guardrail §10)"
LIGHT_REASON = "Lightweight procedural Python in Composer"
SCRIPT_COMMANDS = ("PYODPS", "PYTHON")
SQL_HEADS = ("sql", "select", "insert")
HEAVY_MARKERS = ("read_sql(", "o2o", ".apply(", "spark", "join", "groupby", "pivot")
PUSHDOWN_MARKER = "o2o"

# source type -> collapsed warehouse type
WAREHOUSE_TYPES = {
    "TINYINT": "INT64",
    "SMALLINT": "INT64",
    "INT": "INT64",
    "BIGINT": "INT64",
    "FLOAT": "FLOAT64",
    "DOUBLE": "FLOAT64",
    "STRING": "STRING",
    "VARCHAR": "STRING",
    "CHAR": "STRING",
    "DATE": "DATE",
    "DATETIME": "DATETIME",
    "TIMESTAMP": "TIMESTAMP",
    "BOOLEAN": "BOOL",
    "BINARY": "BYTES",
}
# source type -> Spark type
SPARK_TYPES = {
    "TINYINT": "tinyint",
    "SMALLINT": "smallint",
    "INT": "int",
    "BIGINT": "bigint",
    "FLOAT": "float",
    "DOUBLE": "double",
    "STRING": "string",
    "VARCHAR": "string",
    "CHAR": "string",
    "DATE": "date",
    "DATETIME": "timestamp_ntz",
    "TIMESTAMP": "timestamp",
    "BOOLEAN": "boolean",
    "BINARY": "binary",
}
MAX_DECIMAL_PRECISION = 38

# function -> name it is safely rewritten to
RENAMED_FUNCTIONS = {
    "NVL": "IFNULL",
    "IF": "IF",
    "COALESCE": "COALESCE",
    "CONCAT": "CONCAT",
    "LENGTH": "LENGTH",
    "UPPER": "UPPER",
    "LOWER": "LOWER",
    "TRIM": "TRIM",
    "ABS": "ABS",
    "ROUND": "ROUND",
    "GREATEST": "GREATEST",
    "LEAST": "LEAST",
    "REGEXP_REPLACE": "REGEXP_REPLACE",
    "REGEXP_EXTRACT": "REGEXP_EXTRACT",
    "TO_DATE": "DATE",
}
# functions whose meaning differs between warehouses
REVIEWED_FUNCTIONS = (
    "DATEADD", "DATEDIFF", "DATEPART", "UNIX_TIMESTAMP", "FROM_UNIXTIME",
    "SPLIT_PART", "WM_CONCAT", "MAPJOIN", "LATERAL", "EXPLODE", "STACK",
)
RESERVED_WORDS = (
    "default", "rank", "row", "rows", "group", "order", "over",
    "range", "current", "partition", "window", "values", "source",
)
# End of the fixed values.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One line of an ordered rule table: the first true condition decides."""

    condition: Column
    target: Column | str
    reason: Column | str = ""


def first_match(rules: Sequence[Rule], default: Rule) -> tuple[Column, Column]:
    """Target and reason of the first rule that holds; null conditions do not hold."""

    def chain(pick) -> Column:
        result = pick(default)
        for rule in reversed(rules):
            result = F.when(F.coalesce(rule.condition, F.lit(False)), pick(rule)).otherwise(result)
        return result

    def as_col(value: Column | str) -> Column:
        return F.lit(value) if isinstance(value, str) else value

    return chain(lambda r: as_col(r.target)), chain(lambda r: as_col(r.reason))


def contains_any(col: Column, markers: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(col, F.lit(m)) for m in markers])


def starts_like(col: Column, heads: Sequence[str]) -> Column:
    """True if the text, without leading blanks and case, starts with one of ``heads``."""
    return col.rlike(r"(?i)^\s*(" + "|".join(heads) + ")")


def lookup(col: Column, table: dict[str, str], default: Column | str | None = None) -> Column:
    """Look a value up in a small fixed table."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), col)
    if default is None:
        return found
    return F.coalesce(found, F.lit(default) if isinstance(default, str) else default)


def route_for_build(command: Column, content: Column, max_chars: int | None = None) -> tuple[Column, Column]:
    """Target and reason of a node in the build profile.

    Order: plain SQL and flow control, then SQL inside a script, then heavy
    scripts, then (optionally) scripts too long to judge, then light scripts;
    everything else goes to review.
    """
    script = command.isin(*SCRIPT_COMMANDS)
    body = F.coalesce(content, F.lit(""))
    rules = [
        Rule(command == "ODPS_SQL", SQL_TARGET, command),
        Rule(command == "VIRTUAL", EMPTY_TARGET, command),
        Rule(script & starts_like(body, SQL_HEADS), SQL_TARGET, SQL_REASON),
        Rule(script & contains_any(F.lower(body), HEAVY_MARKERS), HEAVY_TARGET, HEAVY_REASON_BUILD),
    ]
    if max_chars is not None:
        rules.append(Rule(script & (F.length(body) > max_chars), REVIEW_TARGET, f"Script longer than {max_chars} characters"))
    rules.append(Rule(script, LIGHT_TARGET, LIGHT_REASON))
    return first_match(rules, Rule(F.lit(True), REVIEW_TARGET, lookup(command, REVIEW_COMMANDS, REVIEW_DEFAULT)))


def route_for_planning(command: Column, content: Column) -> tuple[Column, Column]:
    """Target and reason of a node in the planning profile."""
    script = command.isin(*SCRIPT_COMMANDS)
    body = F.coalesce(content, F.lit(""))
    pushed = F.contains(F.lower(body), F.lit(PUSHDOWN_MARKER)) | starts_like(body, SQL_HEADS)
    rules = [
        Rule(script & pushed, SQL_TARGET, SQL_REASON),
        Rule(script & contains_any(F.lower(body), HEAVY_MARKERS), HEAVY_TARGET, HEAVY_REASON),
        Rule(script, LIGHT_TARGET, LIGHT_REASON),
    ]
    targets = {k: v[0] for k, v in PLANNING_ROUTES.items()}
    reasons = {k: v[1] for k, v in PLANNING_ROUTES.items()}
    default = Rule(
        F.lit(True),
        lookup(command, targets, PLANNING_DEFAULT[0]),
        lookup(command, reasons, PLANNING_DEFAULT[1]),
    )
    return first_match(rules, default)


# One piece of a type text: a sized scalar, an opening of a nested type, a field name, a word, a sign.
_PIECES = (
    r"(?:DECIMAL|NUMERIC)\(\s*\d+\s*,\s*\d+\s*\)\s*|(?:VARCHAR|CHAR)\(\s*\d+\s*\)\s*"
    r"|(?:MAP|ARRAY|STRUCT)\s*<\s*|\w+\s*:\s*|\w+\s*|[^\w\s]\s*"
)


def base_type(type_text: Column) -> Column:
    return F.upper(F.regexp_extract(F.trim(type_text), r"^(\w+)", 1))


def _scalar(word: Column) -> Column:
    """Warehouse type, Spark type and whether it is known, of a type that is not nested."""
    precision = F.regexp_extract(word, r"^(?:DECIMAL|NUMERIC)\(\s*(\d+)\s*,\s*\d+\s*\)$", 1).try_cast("int")
    digits = F.regexp_extract(word, r"^(?:DECIMAL|NUMERIC)(\(\s*\d+\s*,\s*\d+\s*\))$", 1)
    sized = word.rlike(r"^(VARCHAR|CHAR)\(\s*\d+\s*\)$")
    fits = F.coalesce(precision <= MAX_DECIMAL_PRECISION, F.lit(False))
    warehouse = (
        F.when(sized, F.lit("STRING"))
        .when(fits, F.lit("NUMERIC"))
        .when(precision.isNotNull(), F.lit("BIGNUMERIC"))
        .otherwise(lookup(word, WAREHOUSE_TYPES, word))
    )
    spark = (
        F.when(sized, F.lit("string"))
        .when(fits, F.concat(F.lit("decimal"), F.regexp_replace(digits, " ", "")))
        .otherwise(lookup(word, SPARK_TYPES, word))
    )
    known = sized | fits | word.isin(*WAREHOUSE_TYPES)
    return F.struct(warehouse.alias("warehouse"), spark.alias("spark"), known.alias("known"))


def type_parts(type_text: Column) -> Column:
    """Warehouse type, Spark type and flag of a source type, nested to any depth, as one struct.

    The pieces of the text are folded from left to right with a stack of the
    open types: ``M`` and ``m`` are a map before and behind its comma, ``A`` an array,
    ``S`` a struct.  ``next`` is what may follow: a type, a field name, or nothing
    but a sign.  Inside a struct the warehouse type is the source text.  A text
    that is no type keeps its own text and is flagged; so is a type with an
    unknown one at any depth.
    """
    text = F.upper(F.trim(F.coalesce(type_text, F.lit(""))))
    found = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))
    pieces = F.transform(
        found, lambda p: F.struct(p.alias("raw"), F.trim(p).alias("word"), _scalar(F.trim(p)).alias("scalar"))
    )

    def step(state: Column, piece: Column) -> Column:
        word, stack = piece["word"], state["stack"]
        top, below = F.right(stack, F.lit(1)), F.left(stack, F.length(stack) - 1)
        inside = F.contains(stack, F.lit("S"))

        def then(warehouse, spark, new_stack, following, known=None):
            as_text = [F.lit(v) if isinstance(v, str) else v for v in (warehouse, spark, new_stack, following)]
            return F.struct(
                F.concat(state["warehouse"], F.when(inside, piece["raw"]).otherwise(as_text[0])).alias("warehouse"),
                F.concat(state["spark"], as_text[1]).alias("spark"),
                (state["flagged"] if known is None else state["flagged"] | ~known).alias("flagged"),
                as_text[2].alias("stack"),
                as_text[3].alias("next"),
            )

        def opened(letter, warehouse, spark, following):
            return then(warehouse, spark, F.concat(stack, F.lit(letter)), following)

        wanted = state["next"]
        kind = F.regexp_replace(word, r"\s", "")
        broken = F.struct(
            state["warehouse"], state["spark"], F.lit(True).alias("flagged"), F.lit("?").alias("stack"), F.lit("none").alias("next")
        )
        name = F.concat(F.lower(F.regexp_replace(word, r"\s*:$", "")), F.lit(":"))
        return (
            F.when(stack == "?", state)
            .when((kind == "MAP<") & (wanted == "type"), opened("M", "ARRAY<STRUCT<key ", "map<", "type"))
            .when((kind == "ARRAY<") & (wanted == "type"), opened("A", "ARRAY<", "array<", "type"))
            .when((kind == "STRUCT<") & (wanted == "type"), opened("S", "STRUCT<", "struct<", "field"))
            .when((word == ",") & (wanted == "sign") & (top == "M"), then(", value ", ", ", F.concat(below, F.lit("m")), "type"))
            .when((word == ",") & (wanted == "sign") & (top == "S"), then(",", ", ", stack, "field"))
            .when((word == ">") & (wanted == "sign") & (top == "m"), then(">>", ">", below, "sign"))
            .when((word == ">") & (wanted == "sign") & top.isin("A", "S"), then(">", ">", below, "sign"))
            .when(F.endswith(word, F.lit(":")) & (wanted == "field"), then(word, name, stack, "type"))
            .when(
                word.rlike(r"^\w") & (wanted == "type"),
                then(piece["scalar"]["warehouse"], piece["scalar"]["spark"], stack, "sign", piece["scalar"]["known"]),
            )
            .otherwise(broken)
        )

    start = F.struct(
        F.lit("").alias("warehouse"), F.lit("").alias("spark"), F.lit(False).alias("flagged"),
        F.lit("").alias("stack"), F.lit("type").alias("next"),
    )

    def finish(state: Column) -> Column:
        whole = (state["stack"] == "") & (state["next"] == "sign")
        return F.struct(
            F.when(whole, state["warehouse"]).otherwise(text).alias("warehouse"),
            F.when(whole, state["spark"]).otherwise(text).alias("spark"),
            (~whole | state["flagged"]).alias("flagged"),
        )

    return F.aggregate(pieces, start, step, finish)


def warehouse_type(type_text: Column) -> Column:
    """Collapsed type of a source type; an unknown type stays as it is."""
    return type_parts(type_text)["warehouse"]


def spark_type(type_text: Column) -> Column:
    """Spark type of a source type; an unknown type stays as it is."""
    return type_parts(type_text)["spark"]


def type_flag(type_text: Column) -> Column:
    """True where a type is unknown at any depth or cannot be held, so a person must look."""
    return type_parts(type_text)["flagged"]
