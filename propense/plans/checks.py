"""Rules for the role tables and for the raw tables."""

from __future__ import annotations

from propense.operators.quality import FieldSpec, Rule
from propense.plans.roles import EVENT_TYPES, PRODUCTS

NUMBER = (Rule("positive"), Rule("non_null"), Rule("type", "numerical"))


def _spec(table: str, field: str, *rules: Rule, layer: str = "roles") -> FieldSpec:
    return FieldSpec(f"{table}_{field}", table, field, rules, layer)


def _pair(table: str, field: str, partner: str, *more: Rule) -> FieldSpec:
    sync = (Rule("sync_null", partner), Rule("sync_zero", partner), Rule("non_zero"))
    return _spec(table, field, *NUMBER, *sync, *more)


def role_specs() -> list[FieldSpec]:
    specs = [
        _spec("profile", "client", Rule("unique"), *NUMBER),
        _spec(
            "profile",
            "segment",
            Rule("enum", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")),
            Rule("non_null"),
            Rule("type", "string"),
        ),
        _spec("profile", "acctbal", *NUMBER, Rule("non_zero")),
        _spec("profile", "nation", Rule("enum", tuple(range(20))), *NUMBER),
        _spec("balances", "client", Rule("unique"), *NUMBER),
        _spec("flows", "client", Rule("unique"), *NUMBER),
        _spec("sales", "client", Rule("unique"), *NUMBER),
    ]
    for p in PRODUCTS:
        specs += [
            _pair("balances", f"count_{p}", f"bal_{p}"),
            _pair("balances", f"bal_{p}", f"count_{p}"),
            _pair("sales", f"sale_{p}", f"revenue_{p}", Rule("enum", (0, 1))),
            _pair("sales", f"revenue_{p}", f"sale_{p}"),
            _pair("train", f"count_{p}", "acctbal"),
        ]
    for e in EVENT_TYPES:
        specs += [
            _pair("flows", f"volume_{e}", f"txn_{e}"),
            _pair("flows", f"txn_{e}", f"volume_{e}"),
            _pair("train", f"volume_{e}", "count_o"),
        ]
    return specs


def raw_specs() -> list[FieldSpec]:
    def raw(table, field, *rules):
        return _spec(table, field, *rules, layer="raw")

    return [
        raw("orders", "o_orderkey", Rule("unique"), *NUMBER),
        raw("orders", "o_custkey", Rule("unique"), *NUMBER),
        raw("orders", "o_orderstatus", Rule("enum", ("O", "F")), Rule("type", "numerical")),
        raw("orders", "o_orderdate", Rule("type", "datetime"), Rule("non_null")),
        raw("orders", "o_orderpriority", Rule("type", "datetime"), Rule("type", "string")),
        raw("lineitem", "l_orderkey", Rule("unique")),
        raw("lineitem", "l_discount", *NUMBER, Rule("non_zero"), Rule("sync_zero", "l_tax")),
        raw("lineitem", "l_shipdate", Rule("type", "datetime")),
        raw("events", "props", Rule("type", "numerical"), Rule("type", "datetime"), Rule("unique")),
        raw("documents", "source", Rule("unique"), Rule("type", "numerical")),
        raw("documents", "n_chars", *NUMBER),
        raw("labels", "toxic", Rule("enum", (0, 1)), Rule("sync_zero", "quality"), Rule("non_zero")),
    ]


def by_rule() -> dict[str, list[FieldSpec]]:
    """The specs split into one query per kind of rule."""
    out: dict[str, list[FieldSpec]] = {}
    for spec in role_specs() + raw_specs():
        for rule in spec.rules:
            kind = f"type_{rule.argument}" if rule.kind == "type" else rule.kind
            one = FieldSpec(spec.name, spec.table, spec.field, (rule,), spec.layer, spec.database)
            out.setdefault(f"dq_{kind}", []).append(one)
    return out
