"""Checks of fact rows before they are loaded: a bad value costs its row, not the load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.facts import FactSpec, record_natural_key
from starloom.operators.quality import MEASURE_RULES, RuleSet
from starloom.operators.quarantine import build_error_records, payload_json
from starloom.schemas import TABLES, table_schema

VIOLATIONS = "_violations"
NULL_KEY, BAD_TYPE, BROKEN_RULE = "NULL_PK", "TYPE_MISMATCH", "VALIDATION_FAIL"

#: Rules by fact; a fact without any is checked for its key and its types only.
RULES: dict[str, RuleSet] = {"FactSales": MEASURE_RULES}


def register_rules(fact: str, rules: RuleSet) -> None:
    """Set the rules that rows of a fact must keep to be loaded."""
    RULES[fact] = rules


def _found(kind: str, message: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), message.alias("message"))


def _lossy(name: str, source: T.DataType, target: T.DataType) -> Column | None:
    """Whether a value does not fit the stored type; None where every value fits."""
    if source == target or isinstance(target, T.StringType):
        return None
    return F.col(name).isNotNull() & F.col(name).try_cast(target).isNull()


def checked(rows: DataFrame, spec: FactSpec) -> DataFrame:
    """``rows`` with the array of what is wrong with each: missing record key, values that do not fit, broken rules."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    needed = dict.fromkeys([*spec.record_key, spec.date_key])  # a row without its day has no place in the table
    found = [F.when(F.col(c).isNull(), _found(NULL_KEY, F.lit(f"{c} is NULL"))) for c in needed if c in kinds]
    for field in table_schema(spec.name).fields if spec.name in TABLES else ():
        lossy = _lossy(field.name, kinds[field.name], field.dataType) if field.name in kinds else None
        if lossy is not None:
            message = f"cannot convert {field.name} to {field.dataType.simpleString()}"
            found.append(F.when(lossy, _found(BAD_TYPE, F.lit(message))))
    rules = RULES.get(spec.name)
    for rule in rules.rules if rules else ():
        breaks = F.expr(rule.breaks) if isinstance(rule.breaks, str) else rule.breaks
        found.append(F.when(breaks, _found(BROKEN_RULE, F.lit(rule.message))))
    nothing = F.array().cast("array<struct<kind:string,message:string>>")
    return rows.withColumn(VIOLATIONS, F.array_compact(F.array(*found)) if found else nothing)


def is_valid() -> Column:
    return F.size(VIOLATIONS) == 0


def validation_errors(invalid: DataFrame, spec: FactSpec, batch_id: str, error_time=None) -> DataFrame:
    """One error record per invalid row, of the kind of its first violation, with all messages and the whole row.

    A row without its key can't be retried, it would not be found again.
    """
    names = [c for c in invalid.columns if not c.startswith("_")]
    kind = F.col(VIOLATIONS)[0]["kind"]
    errors = build_error_records(
        invalid, source_table=spec.name, natural_key=record_natural_key(invalid, spec), payload=payload_json(names),
        message=F.array_join(F.transform(VIOLATIONS, lambda v: v["message"]), "; "), error_type=kind,
        task_name=f"load_fact_{spec.name.lower()}", batch_id=batch_id, error_time=error_time,
    )
    lost = F.col("ErrorType") == NULL_KEY
    return errors.withColumns(
        {
            "ErrorSeverity": F.when(lost, "CRITICAL").otherwise(F.col("ErrorSeverity")),
            "IsRecoverable": F.when(lost, 0).otherwise(F.col("IsRecoverable")),
        }
    )
