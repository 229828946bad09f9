"""The search language as Spark predicates.

Every builder returns a :class:`Predicate`, which becomes one boolean ``Column`` once the frame is
known (a field may be a scalar, an array, or analyzed text). Positive predicates stay bare
comparisons so that Catalyst pushes them into the scan; only a negated part is wrapped in
``coalesce``, because a missing field does not match and therefore does satisfy ``must_not``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .fields import TEMPORAL, Fields, literal, locate

WORD = r"[a-z0-9\p{L}\p{N}]"
WORD_END = f"(?!{WORD})"
FEW_WORDS = 8
_PY_WORDS = re.compile(r"[^\W_]+")


def analyze(text) -> list[str]:
    """Lower-cased words of a query string, in order, without repeats."""
    return list(dict.fromkeys(_PY_WORDS.findall(str(text).lower())))


class Predicate:
    """A condition waiting for its frame. ``recheck`` marks filters Spark has to evaluate again
    even when the search side already answered them."""

    def __init__(self, build: Callable[[Fields], Column], recheck: bool = False, conjuncts=None):
        self._build, self.recheck = build, recheck
        self.conjuncts: list[Predicate] = conjuncts or [self]

    def column(self, fields: Fields) -> Column:
        return self._build(fields)

    def on(self, df: DataFrame, text=()) -> Column:
        return self._build(Fields(df.schema, text))

    def __and__(self, other: "Predicate") -> "Predicate":
        return Predicate(
            lambda x: self.column(x) & other.column(x),
            self.recheck or other.recheck,
            self.conjuncts + other.conjuncts,
        )

    def __or__(self, other: "Predicate") -> "Predicate":
        return Predicate(lambda x: self.column(x) | other.column(x), self.recheck or other.recheck)

    def __invert__(self) -> "Predicate":
        return Predicate(
            lambda x: ~self.column(x) if x.mode == "exact" else negate(self.column(x)), self.recheck
        )


def negate(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def all_of(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns, F.lit(True))


def any_of(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns, F.lit(False))


# -- query language ------------------------------------------------------------------------------


def match_all() -> Predicate:
    return Predicate(lambda x: F.lit(True))


def term(field: str, value) -> Predicate:
    """Exact value; on analyzed text, one exact (lower-cased) word."""
    if value is None:
        return missing(field)
    return Predicate(lambda x: x.any_value(field, _term_test(x, field, value)))


def _term_test(fields: Fields, name: str, value):
    if fields.is_text(name):
        return lambda c, kind: _has_words(c, [str(value)]) if analyze(value) == [str(value)] else F.lit(False)
    return lambda c, kind: c == literal(value, kind)


def _starting(literal: str) -> str:
    """Regular expression for a literal at the start of a word. The literal comes first and what stands
    before it is checked afterwards, so that most of the text is skipped by plain comparison."""
    return f"{literal}(?<!{WORD}{literal})"


def _has_words(column: Column, words: list[str]) -> Column:
    """Whether one of the words occurs. No word array is built per row: a substring test for a few words,
    then one regular expression."""
    if not words:
        return F.lit(False)
    text = F.lower(column)
    found = text.rlike("|".join(_starting(w) + WORD_END for w in words))
    return any_of(text.contains(w) for w in words) & found if 1 < len(words) <= FEW_WORDS else found


def terms(field: str, values: Iterable) -> Predicate:
    """Any of a set of exact values; nulls are dropped and an empty set matches nothing."""
    wanted = list(dict.fromkeys(v for v in values if v is not None))

    def build(x: Fields) -> Column:
        if not wanted:
            return F.lit(False)
        if x.is_text(field):
            words = [str(v) for v in wanted if analyze(v) == [str(v)]]
            return x.any_value(field, lambda c, kind: _has_words(c, words))
        return x.any_value(field, lambda c, kind: c.isin([literal(v, kind) for v in wanted]))

    return Predicate(build)


def match(field: str, text, operator: str = "or") -> Predicate:
    """Analyzed match: on text fields the words of ``text`` are OR-ed (or AND-ed); on other fields
    the whole value is compared."""
    if text is None:
        return missing(field)
    if operator.lower() not in ("or", "and"):
        raise ValueError(f"unknown operator [{operator}]")

    def build(x: Fields) -> Column:
        if not x.is_text(field):
            return x.any_value(field, lambda c, kind: c == literal(text, kind))
        words = analyze(text)
        if operator.lower() == "or" or not words:
            return x.any_value(field, lambda c, kind: _has_words(c, words))
        return all_of(x.any_value(field, lambda c, kind, w=w: _has_words(c, [w])) for w in words)

    return Predicate(build)


def match_any(field: str, values: Iterable) -> Predicate:
    """A mixed value list: numbers as exact terms, strings as one analyzed match, OR-ed. Date fields
    are always compared exactly."""
    wanted = [v for v in values if v is not None]
    numbers = [v for v in wanted if isinstance(v, (int, float)) and not isinstance(v, bool)]
    others = [v for v in wanted if v not in numbers or isinstance(v, bool)]

    def build(x: Fields) -> Column:
        if isinstance(x.kind(field), TEMPORAL):
            return terms(field, wanted).column(x)
        parts = [terms(field, numbers).column(x)] if numbers else []
        if others and x.is_text(field):
            parts.append(match(field, " ".join(map(str, others))).column(x))
        elif others:
            parts.append(terms(field, others).column(x))
        return any_of(parts)

    return Predicate(build)


def range(field: str, gt=None, gte=None, lt=None, lte=None) -> Predicate:  # noqa: A001
    bounds = [(v, op) for v, op in ((gt, "gt"), (gte, "ge"), (lt, "lt"), (lte, "le")) if v is not None]
    if not bounds:
        raise ValueError(f"range on [{field}] has no bound")

    def test(c: Column, kind: T.DataType) -> Column:
        compare = {
            "gt": lambda v: c > v,
            "ge": lambda v: c >= v,
            "lt": lambda v: c < v,
            "le": lambda v: c <= v,
        }
        return all_of(compare[op](literal(v, kind)) for v, op in bounds)

    return Predicate(lambda x: x.any_value(field, test))


def exists(field: str) -> Predicate:
    """At least one non-null value: neither a null nor an empty array exists."""
    return Predicate(lambda x: x.any_value(field, lambda c, kind: c.isNotNull()))


def missing(field: str) -> Predicate:
    def build(x: Fields) -> Column:
        try:
            column, _, depth = locate(x.schema, field)
        except KeyError:
            return F.lit(True)
        return negate(exists(field).column(x)) if depth else column.isNull()

    return Predicate(build)


def _pattern_test(fields: Fields, name: str, pattern: str):
    """``*`` wildcards: over each word of an analyzed field, otherwise over the whole value."""
    literals = pattern.split("*")
    if fields.is_text(name):
        return _word_pattern_test(literals)
    escaped = "%".join(re.sub(r"([\\%_])", r"\\\1", part) for part in literals)
    return lambda c, kind: _text(c, kind).like(escaped)


def _word_pattern_test(literals: list[str]):
    """Words are maximal runs of letters and digits, so literals joined by such runs stay in one word."""
    inner = [part for part in literals if part]
    if any(_PY_WORDS.sub("", part) for part in inner):
        return lambda c, kind: F.lit(False)  # no word holds such a character
    if not inner:
        return lambda c, kind: F.lower(c).rlike(WORD)
    if len(inner) == 1 and not literals[0] and not literals[-1]:
        return lambda c, kind: F.lower(c).contains(inner[0])
    first = _starting(inner[0]) if literals[0] else inner[0]
    expression = f"{WORD}*".join([first, *inner[1:]]) + (WORD_END if literals[-1] else "")
    return lambda c, kind: F.lower(c).rlike(expression)


def _text(column: Column, kind: T.DataType) -> Column:
    return column if isinstance(kind, T.StringType) else column.cast("string")


def wildcard(field: str, pattern: str) -> Predicate:
    return Predicate(lambda x: x.any_value(field, _pattern_test(x, field, pattern)))


def _affix(field: str, value: str, strict: bool | None, words, plain) -> Predicate:
    def build(x: Fields) -> Column:
        if x.mode == "exact" and strict is None:
            return x.any_value(field, lambda c, kind: plain(_text(c, kind), value))
        keep_case = strict if strict is not None else x.mode == "strict"
        wanted = value if keep_case else value.lower()
        if x.is_text(field):
            return x.any_value(field, _pattern_test(x, field, words(wanted)))
        return x.any_value(field, lambda c, kind: plain(_text(c, kind), wanted))

    return Predicate(build)


def starts_with(field: str, value: str, strict: bool | None = None) -> Predicate:
    """Prefix of the value, or of some word of analyzed text; lower-cased first unless strict."""
    return _affix(field, value, strict, lambda v: v + "*", lambda c, v: c.startswith(v))


def ends_with(field: str, value: str, strict: bool | None = None) -> Predicate:
    return _affix(field, value, strict, lambda v: "*" + v, lambda c, v: c.endswith(v))


def contains(field: str, value: str, strict: bool | None = None) -> Predicate:
    return _affix(field, value, strict, lambda v: f"*{v}*", lambda c, v: c.contains(v))


def bool_(must=(), filter=(), should=(), must_not=(), minimum_should_match: int | None = None) -> Predicate:  # noqa: A002
    """Boolean combination. ``should`` alone needs one match; beside ``must`` or ``filter`` it does
    not restrict, unless ``minimum_should_match`` says so."""
    required = [as_predicate(q) for q in [*_listed(must), *_listed(filter)]]
    optional = [as_predicate(q) for q in _listed(should)]
    banned = [as_predicate(q) for q in _listed(must_not)]
    needed = minimum_should_match
    if needed is None:
        needed = 1 if optional and not required else 0

    def build(x: Fields) -> Column:
        parts = [q.column(x) for q in required]
        if needed == 1:
            parts.append(any_of(q.column(x) for q in optional))
        elif needed > 1:
            hits = [F.coalesce(q.column(x), F.lit(False)).cast("int") for q in optional]
            parts.append(reduce(lambda a, b: a + b, hits, F.lit(0)) >= needed)
        parts += [negate(q.column(x)) for q in banned]
        return all_of(parts)

    return Predicate(build, any(q.recheck for q in required + optional + banned))


def constant_score(query) -> Predicate:
    return as_predicate(query)


def filtered(query, filters=()) -> Predicate:
    """A query narrowed by filters."""
    return reduce(lambda a, b: a & b, (as_predicate(f) for f in _listed(filters)), as_predicate(query))


# -- engine-side filters: what a user writes in Spark, in its three renderings --------------------


def equals(field: str, value) -> Predicate:
    """``field = value`` as an engine filter: a match (analyzed), a term (strict) or plain equality."""

    def build(x: Fields) -> Column:
        if x.mode == "exact":
            return F.lit(False) if x.kind(field) is None else x.any_value(field, lambda c, k: c == literal(value, k))
        return (term if x.mode == "strict" else match)(field, value).column(x)

    return Predicate(build)


def is_not_null(field: str) -> Predicate:
    """``IS NOT NULL`` as an engine filter; on recheck an empty array is a value too."""

    def build(x: Fields) -> Column:
        plain = x.mode == "exact" and x.kind(field) is not None
        return x.column(field).isNotNull() if plain else exists(field).column(x)

    return Predicate(build)


def is_null(field: str) -> Predicate:
    def build(x: Fields) -> Column:
        plain = x.mode == "exact" and x.kind(field) is not None
        return x.column(field).isNull() if plain else missing(field).column(x)

    return Predicate(build)


def null_safe_eq(field: str, value) -> Predicate:
    """Equality under which null equals null and a missing field."""

    def build(x: Fields) -> Column:
        if value is None:
            return is_null(field).column(x)
        if x.mode == "exact":
            return x.any_value(field, lambda c, k: c.eqNullSafe(literal(value, k)))
        return (term if x.mode == "strict" else match)(field, value).column(x)

    return Predicate(build)


def is_in(field: str, values: Iterable) -> Predicate:
    """``field IN (...)`` as an engine filter; Spark always evaluates it again."""
    wanted = list(values)

    def build(x: Fields) -> Column:
        if x.mode == "exact":
            return x.any_value(field, lambda c, k: c.isin([literal(v, k) for v in wanted]))
        return (terms if x.mode == "strict" else match_any)(field, wanted).column(x)

    return Predicate(build, recheck=True)


# -- JSON and URI forms -----------------------------------------------------------------------------


def as_predicate(query) -> Predicate:
    """None, a Predicate, a JSON dict / text, or a ``?q=`` text, as a Predicate."""
    if query is None:
        return match_all()
    if isinstance(query, Predicate):
        return query
    if isinstance(query, str) and query.lstrip().startswith("?"):
        return uri_query(query.strip())
    return dsl(query)


def _listed(value) -> list:
    if value is None:
        return []
    return list(value) if isinstance(value, (list, tuple)) else [value]


def dsl(query) -> Predicate:
    """A query given as a dict or JSON text; an outer ``query`` is unwrapped. An unknown node or
    parameter raises, it is never ignored."""
    node = json.loads(query) if isinstance(query, str) else query
    if not isinstance(node, dict):
        raise ValueError(f"a query must be a JSON object, got [{node!r}]")
    if set(node) == {"query"}:
        node = node["query"]
    if len(node) != 1:
        raise ValueError(f"a query node has exactly one name, got {sorted(node)}")
    ((name, body),) = node.items()
    if name not in _NODES:
        raise ValueError(f"unknown query [{name}]")
    return _NODES[name](body)


def _field_body(name: str, body: dict, key: str, also: tuple[str, ...] = ()) -> tuple[str, dict]:
    """``{field: value}`` or ``{field: {key: value, ...}}``."""
    if not isinstance(body, dict) or len(body) != 1:
        raise ValueError(f"[{name}] takes exactly one field")
    ((field, value),) = body.items()
    options = dict(value) if isinstance(value, dict) else {key: value}
    _only(name, options, (key, *also))
    return field, options


def _only(name: str, options: dict, allowed: tuple[str, ...]) -> dict:
    unknown = set(options) - set(allowed)
    if unknown:
        raise ValueError(f"[{name}] does not support {sorted(unknown)}")
    return options


def _match_node(body: dict) -> Predicate:
    field, options = _field_body("match", body, "query", ("operator",))
    return match(field, options["query"], options.get("operator", "or"))


def _term_node(body: dict) -> Predicate:
    field, options = _field_body("term", body, "value")
    return term(field, options["value"])


def _terms_node(body: dict) -> Predicate:
    ((field, values),) = body.items()
    return terms(field, values)


def _range_node(body: dict) -> Predicate:
    ((field, options),) = body.items()
    for bound in _only("range", options, ("gt", "gte", "lt", "lte")).values():
        if isinstance(bound, str) and (bound.startswith("now") or "||" in bound):
            raise ValueError(f"[range] does not support date arithmetic: [{bound}]")
    return range(field, **options)


def _prefix_node(body: dict) -> Predicate:
    field, options = _field_body("prefix", body, "value")
    return starts_with(field, options["value"], strict=True)


def _wildcard_node(body: dict) -> Predicate:
    field, options = _field_body("wildcard", body, "value")
    if "?" in str(options["value"]):
        raise ValueError("[wildcard] supports [*] only")
    return wildcard(field, options["value"])


def _bool_node(body: dict) -> Predicate:
    return bool_(**_only("bool", body, ("must", "filter", "should", "must_not", "minimum_should_match")))


def _filtered_node(body: dict) -> Predicate:
    _only("filtered", body, ("query", "filter"))
    return filtered(body.get("query"), body.get("filter"))


def _query_string_node(body: dict) -> Predicate:
    options = dict(_only("query_string", body, ("query", *_STRING_OPTIONS)))
    return query_string(options.pop("query"), **options)


# Options of a query string.
_STRING_OPTIONS = ("default_field", "default_operator", "lenient", "lowercase_expanded_terms", "analyze_wildcard")

_NODES: dict[str, Callable[[dict], Predicate]] = {
    "match_all": lambda body: match_all(),
    "match": _match_node,
    "term": _term_node,
    "terms": _terms_node,
    "range": _range_node,
    "exists": lambda body: exists(_only("exists", body, ("field",))["field"]),
    "missing": lambda body: missing(_only("missing", body, ("field",))["field"]),
    "prefix": _prefix_node,
    "wildcard": _wildcard_node,
    "bool": _bool_node,
    "constant_score": lambda body: constant_score(_only("constant_score", body, ("filter",))["filter"]),
    "filtered": _filtered_node,
    "query_string": _query_string_node,
}

_UNSUPPORTED = re.compile(r"[()\[\]{}~^\"\\/!&|<>+?]|^-|:-|^NOT$")


def query_string(
    query: str,
    default_field: str | None = None,
    default_operator: str = "or",
    lenient: bool = True,
    lowercase_expanded_terms: bool = True,
    analyze_wildcard: bool = False,
) -> Predicate:
    """``word``, ``field:word``, ``field:pre*``, ``*`` joined by AND / OR (AND binds closer).

    Without a field a word is looked up in ``default_field``, else in every string field. A value
    that does not fit a field's type matches nothing, or raises unless ``lenient``."""
    if default_operator.lower() not in ("and", "or"):
        raise ValueError(f"unknown default_operator [{default_operator}]")
    if analyze_wildcard:
        raise ValueError("analyze_wildcard is not supported")
    groups: list[list[Predicate]] = [[]]
    joiner = None
    for piece in query.split():
        if piece in ("AND", "OR"):
            joiner = piece.lower()
            continue
        if _UNSUPPORTED.search(piece):
            raise ValueError(f"query string form [{piece}] is not supported")
        if groups[0] and (joiner or default_operator.lower()) == "or":
            groups.append([])
        groups[-1].append(_clause(piece, default_field, lenient, lowercase_expanded_terms))
        joiner = None
    if not groups[0] or joiner:
        raise ValueError(f"incomplete query string [{query}]")
    return Predicate(lambda x: any_of(all_of(p.column(x) for p in group) for group in groups))


def _clause(piece: str, default_field: str | None, lenient: bool, lower: bool) -> Predicate:
    field, _, value = piece.rpartition(":")
    field = field or default_field
    if value == "*":
        return exists(field) if field else match_all()

    def one(x: Fields, name: str) -> Column:
        if "*" in value:
            return wildcard(name, value.lower() if lower and x.is_text(name) else value).column(x)
        kind = x.kind(name)
        if not lenient and kind is not None and not isinstance(kind, T.StringType):
            return x.any_value(name, lambda c, k: c == F.lit(value).cast(k))
        return match(name, value).column(x)

    return Predicate(lambda x: any_of(one(x, name) for name in ([field] if field else x.strings())))


def uri_query(text: str) -> Predicate:
    """``?q=...&df=...&default_operator=...``; an unknown parameter raises."""
    options: dict = {}
    for token in text.lstrip("?").split("&"):
        name, found, value = token.partition("=")
        if not found or not name:
            raise ValueError(f"cannot read [{token}] in URI query [{text}]")
        name = _URI_NAMES.get(name, name)
        if name == "query" or name in _STRING_OPTIONS:
            flag = name in ("lenient", "lowercase_expanded_terms", "analyze_wildcard")
            options[name] = value.strip().lower() == "true" if flag else value
        else:
            raise ValueError(f"unknown URI query parameter [{name}]")
    if "query" not in options:
        raise ValueError(f"URI query [{text}] has no q")
    return query_string(options.pop("query"), **options)


# Names of URI parameters.
_URI_NAMES = {"q": "query", "df": "default_field"}
