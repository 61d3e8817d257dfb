"""Event rules: conjunctive predicates over the fields of one hit.

A rule constrains up to three ``eventInfo`` fields. A constraint is either an exact
value (``field = value``) or :class:`Contains` (``UPPER(field) LIKE '%TOKEN%'``). A null
field never matches. Rules are data: a campaign is a tuple of rules, one feature column
per rule.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("eventCategory", "eventAction", "eventLabel")


@dataclass(frozen=True)
class Contains:
    """Case-folded substring test: ``UPPER(field) LIKE '%<token>%'`` (token upper case)."""

    token: str


Constraint = str | Contains | None


def field_matches(field: Column, constraint: Constraint) -> Column:
    if isinstance(constraint, Contains):
        # LIKE semantics ('_' and '%' in a token are wildcards); Catalyst turns a plain
        # '%token%' pattern into a substring test
        return F.upper(field).like("%" + constraint.token.upper() + "%")
    return field == F.lit(constraint)


def _sql_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@dataclass(frozen=True)
class EventRule:
    name: str
    eventCategory: Constraint = None
    eventAction: Constraint = None
    eventLabel: Constraint = None

    def constraints(self) -> list[tuple[str, Constraint]]:
        return [(f, getattr(self, f)) for f in FIELDS if getattr(self, f) is not None]

    def predicate(self, event_info: Column) -> Column:
        """Boolean column over an ``eventInfo`` struct; null when a tested field is null."""
        parts = [field_matches(event_info.getField(f), c) for f, c in self.constraints()]
        return reduce(and_, parts) if parts else F.lit(True)

    def sql(self, event_info: str) -> str:
        """The same predicate as SQL text (used by the DuckDB oracle)."""
        parts = []
        for f, c in self.constraints():
            if isinstance(c, Contains):
                parts.append(f"UPPER({event_info}.{f}) LIKE {_sql_literal('%' + c.token.upper() + '%')}")
            else:
                parts.append(f"{event_info}.{f} = {_sql_literal(c)}")
        return " AND ".join(parts) if parts else "TRUE"

    @staticmethod
    def from_filter(name: str, field: str, value: str) -> "EventRule":
        canonical = {f.lower(): f for f in FIELDS}.get(field.lower())
        if canonical is None:
            raise ValueError(f"unknown hit field {field!r}; expected one of {FIELDS}")
        return EventRule(name, **{canonical: value})


WORD_BITS = 63


class RuleIndex:
    """All rules of a campaign tested at once: a hit's rules as bits of ``words`` longs.

    A field's bits are those of the rules that do not constrain it, of its value in the
    dictionary of equality constraints, and of the tokens it contains (each token is tested
    once); a hit's bits are the AND of its fields' bits. Rules with equal constraints share a bit.
    """

    def __init__(self, rules: Iterable[EventRule]):
        self.places: dict[tuple, int] = {}
        for rule in rules:
            self.places.setdefault(tuple(rule.constraints()), len(self.places))
        self.words = max(1, -(-len(self.places) // WORD_BITS))

    def place(self, rule: EventRule) -> tuple[int, int]:
        """(word, bit) of a rule."""
        return divmod(self.places[tuple(rule.constraints())], WORD_BITS)

    def _field_bits(self, field: Column, name: str, word: int) -> Column:
        free, values, tokens = 0, {}, {}
        for constraints, place in self.places.items():
            if place // WORD_BITS != word:
                continue
            bit, wanted = 1 << place % WORD_BITS, dict(constraints).get(name)
            if wanted is None:
                free |= bit
            elif isinstance(wanted, Contains):
                tokens[wanted] = tokens.get(wanted, 0) | bit
            else:
                values[wanted] = values.get(wanted, 0) | bit
        bits = F.lit(free).cast("long")
        if values:
            known = F.create_map(*[F.lit(x) if isinstance(x, str) else F.lit(x).cast("long") for pair in values.items() for x in pair])
            bits = bits.bitwiseOR(F.coalesce(F.element_at(known, field), F.lit(0).cast("long")))
        for token, bit in tokens.items():
            bits = bits.bitwiseOR(F.when(field_matches(field, token), F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
        return bits

    def masks(self, event_info: Column) -> list[Column]:
        """The words of one hit."""
        return [reduce(Column.bitwiseAND, [self._field_bits(event_info.getField(f), f, w) for f in FIELDS]) for w in range(self.words)]

    def flag(self, rule: EventRule, masks: list[Column]) -> Column:
        """1 where the hit with these words matches the rule, else 0."""
        word, bit = self.place(rule)
        return F.shiftrightunsigned(masks[word], bit).bitwiseAND(F.lit(1).cast("long"))

    def matches(self, hits: Column) -> Column:
        """The words of a session's hits, in one pass; hits that match no rule are left out. Null for null hits."""

        def words(e: Column) -> Column:
            return F.struct(*[m.alias(f"w{w}") for w, m in enumerate(self.masks(e))])

        def any_rule(m: Column) -> Column:
            return reduce(Column.__or__, [m.getField(f"w{w}") != 0 for w in range(self.words)])

        return F.filter(F.transform(hits, words), any_rule)

    def count(self, rule: EventRule, matches: Column) -> Column:
        """How many of a session's hits match the rule, from :meth:`matches`."""

        def add(n: Column, m: Column) -> Column:
            return n + self.flag(rule, [m.getField(f"w{w}") for w in range(self.words)])

        return F.aggregate(matches, F.lit(0).cast("long"), add)


def _constraint(value) -> Constraint:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, dict) and set(value) == {"contains"}:
        return Contains(value["contains"])
    raise ValueError(f"a constraint is a string, null or {{'contains': token}}, not {value!r}")


def rules_from_json(text: str) -> tuple[tuple[EventRule, ...], EventRule | None]:
    """A campaign as data: ``{"rules": [{"name": .., "eventCategory": .., ...}],
    "conversion": {...}}``; a constraint is a value, null, or ``{"contains": "TOKEN"}``."""
    doc = json.loads(text)

    def rule(d: dict, default_name: str | None = None) -> EventRule:
        extra = set(d) - {"name", *FIELDS}
        if extra:
            raise ValueError(f"unknown rule keys {sorted(extra)}")
        return EventRule(d.get("name", default_name), **{f: _constraint(d.get(f)) for f in FIELDS})

    rules = tuple(rule(d) for d in doc.get("rules", []))
    conversion = rule(doc["conversion"], "y_conversions") if doc.get("conversion") else None
    return rules, conversion


# --- fixed values: the campaign's event rules and conversion rule -------------------
# (name, eventCategory, eventAction, eventLabel); CONTROLE marks UPPER(x) LIKE '%CONTROLE%'
_K = Contains("CONTROLE")
CAMPAIGN_RULES: tuple[EventRule, ...] = (
    EventRule("Event01", "tim-controle-lp", None, "contratar-agora!"),
    EventRule("Event02", "tim-controle-conheca-os-planos-e-promocoes", None, "contratar-agora"),
    EventRule("Event03", "tim-controle-conheca-os-planos-e-promocoes", "tim-controle-planos", "mais-planos-controle"),
    EventRule("Event04", "tim-controle-modal", None, "portabilidade-migracao"),
    EventRule("Event05", "tim-controle-conheca-os-planos-e-promocoes", None, "contratar-agora"),
    EventRule("Event06", "tim-controle-light-planos-tim", "tim-controle-light", "contratar-agora"),
    EventRule("Event07", "menu-principal", "menu-planos", "tim-controle"),
    EventRule("Event08", "home-para-voce", "banner-superior-item", "controle"),
    EventRule("Event09", "home-para-voce-banner-central", None, None),
    EventRule("Event10", "menu-principal", "menu-planos", "controle"),
    EventRule("Event11", _K, "dados-pessoais", "sucesso"),
    EventRule("Event12", _K, "criar-cadastro", "sucesso"),
    EventRule("Event13", _K, "endereco", "sucesso"),
    EventRule("Event14", None, None, "sucesso"),
    EventRule("Event15", "ecommerce-chatbot", "adesao", _K),
    EventRule("Event16", _K, "pagamento-fatura-impressa", "sucesso"),
    EventRule("Event17", _K, "pagamento-express-impressa", "sucesso"),
    EventRule("Event18", _K, "pagamento-debito-impressa", "sucesso"),
    EventRule("Event19", _K, "pagamento-fatura-digital", "sucesso"),
    EventRule("Event20", _K, "pagamento-express-digital", "sucesso"),
    EventRule("Event21", _K, "pagamento-debito-digital", "sucesso"),
    EventRule("Event22", _K, "tim-negocia", "sucesso"),
    EventRule("Event23", _K, "sms", "sucesso"),
    EventRule("Event24", _K, "oferta-pre", "sucesso"),
    EventRule("Event25", _K, "oferta-express", "sucesso"),
)
CONVERSION_RULE = EventRule("y_conversions", "ecommerce", "adesao", _K)
# --- end of fixed values --------------------------------------------------------------

# Rule set of the same shapes for the benchmark-table sessions (hit category is the
# event type, action 'k0'..'k9', label Plan-Basic / plan-plus / other / null).
FIXTURE_RULES: tuple[EventRule, ...] = (
    EventRule("Event01", eventCategory="click", eventLabel="other"),
    EventRule("Event02", eventCategory="view", eventAction="k3"),
    EventRule("Event03", eventCategory="purchase", eventLabel=Contains("PLAN")),
    EventRule("Event04", eventLabel="other"),
)
FIXTURE_CONVERSION = EventRule("y_conversions", "purchase", "k3", Contains("PLAN"))
