"""Row rules generated from a contract, and the reject-reason label.

Rule order: not parsed, required/blank in declared order, same-day checks,
period, ranges.  A row gets every failing message, joined by ``"; "``; the
empty string means accepted.

Each rule is generated as SQL expression text and turned into a Column with
``F.expr``; the whole label is one expression, parsed by the JVM in one call.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.contract import Contract
from sluice.functions.sqltext import ident, number, text


def rule_sql(contract: Contract, present: set[str] | None = None) -> list[tuple[str, str, str]]:
    """``(rule_id, failing_condition_sql, message)`` for every rule of the contract.

    ``present`` lists the columns of the frame; the corrupt-record rule is only
    emitted when that column exists.  Time bounds are string literals, which
    Spark coerces to the column's own timestamp type.
    """
    rules: list[tuple[str, str, str]] = []
    cc = contract.corrupt_column
    if cc and (present is None or cc in present):
        rules.append(("corrupt", f"{ident(cc)} IS NOT NULL", contract.message("corrupt")))
    for name in contract.required:
        c = ident(name)
        if name in contract.blank:
            empty = f"{c} RLIKE '^\\\\s*$'" if contract.blank_whitespace else f"trim({c}) = ''"
            rules.append((f"blank:{name}", f"({c} IS NULL OR {empty})", contract.message("blank", name)))
        else:
            rules.append((f"missing:{name}", f"{c} IS NULL", contract.message("missing", name)))
    for rule in contract.same_day:
        d, ts = ident(rule.date_column), ident(rule.ts_column)
        rules.append((f"same_day:{rule.date_column}",
                      f"({d} IS NOT NULL AND {ts} IS NOT NULL AND {d} <> to_date({ts}))", rule.text()))
    if contract.period is not None:
        p = contract.period
        ts = ident(p.column)
        rules.append((f"period:{p.column}",
                      f"({ts} IS NOT NULL AND ({ts} < {text(p.start)} OR {ts} >= {text(p.end)}))", p.text()))
    for r in contract.ranges:
        c = ident(r.column)
        # NaN sorts above every number, so it falls outside every range.
        rules.append((f"range:{r.column}",
                      f"({c} IS NOT NULL AND NOT ({c} BETWEEN {number(r.low)} AND {number(r.high)}))", r.text()))
    return rules


def rule_conditions(contract: Contract, present: set[str] | None = None) -> list[tuple[str, Column, str]]:
    """The rules as Columns: ``(rule_id, failing_condition, message)``."""
    return [(rid, F.expr(cond), msg) for rid, cond, msg in rule_sql(contract, present)]


def reject_reason_sql(contract: Contract, present: set[str] | None = None) -> str:
    parts = [f"CASE WHEN {cond} THEN {text(msg)} END" for _, cond, msg in rule_sql(contract, present)]
    return f"concat_ws('; ', {', '.join(parts)})" if parts else "''"


def reject_reason(contract: Contract, present: set[str] | None = None) -> Column:
    """All failing messages in rule order, ``"; "``-joined; ``''`` when none fail."""
    return F.expr(reject_reason_sql(contract, present))
