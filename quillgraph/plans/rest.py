"""REST-style operations over tables: an operation spec, typed columns, filters, sorting and reshaping [RO-*, UD-01]."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as tx

# What the types of fields are in Spark.
TYPES = {"str": "string", "int": "bigint", "float": "double", "datetime": "string", "duration": "string"}
PREPROCESS: dict[str, Callable[[str], tuple]] = {
    "lower": lambda s: (s.lower(),),
    "upper": lambda s: (s.upper(),),
    "encode": lambda s: (__import__("urllib.parse").parse.quote(s),),
    "split_dois": lambda s: (s.split("__"),),
}


def parse_spec(text: str) -> list[dict[str, str]]:
    """[RO-01] Sections divided by blank lines, of fields ``#name value``; a value goes on until the next field."""
    out = []
    for section in re.split(r"\n\s*\n(?=#)", text.strip()):
        fields: dict[str, str] = {}
        name = None
        for line in section.split("\n"):
            m = re.match(r"#(\S+)\s?(.*)", line)
            if m:
                name = m[1]
                fields[name] = m[2]
            elif name:
                fields[name] += "\n" + line
        if fields:
            out.append({k: v.strip() for k, v in fields.items()})
    return out


def parameter_types(spec: dict[str, str]) -> dict[str, tuple[str, str]]:
    """[RO-02] Type and pattern of each variable of an operation's URL."""
    names = re.findall(r"{(\w+)}", spec.get("url", ""))
    found = {n: re.match(r"(\w+)\((.*)\)$", spec.get(n, "str(.+)"), re.S) for n in names}
    return {n: (m[1], m[2]) for n, m in found.items()}


def validated(value: str, pattern: str) -> str:
    if not re.fullmatch(pattern, value):
        raise ValueError(f"{value!r} does not match {pattern}")
    return value


def preprocessed(value: str, chain: str) -> object:
    """[RO-03] ``f(a) --> g(a)``: each function gets what the one before returned."""
    for step in filter(None, map(str.strip, chain.split("-->"))):
        (value,) = PREPROCESS[step.partition("(")[0]](value)
    return value


def field_types(spec: dict[str, str]) -> dict[str, str]:
    """[RO-04] Column types from ``type(name) ...``."""
    return {name: kind for kind, name in re.findall(r"(\w+)\((\w+)\)", spec.get("field_type", ""))}


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """[RO-04] Columns cast to their types; what cannot be cast is null. Dates stay lexical, as parts of them may be missing."""
    return df.select(*[F.expr(f"try_cast(`{c}` AS {TYPES[types[c]]})").alias(c) if c in types else F.col(c) for c in df.columns])


def plain(df: DataFrame) -> DataFrame:
    """Every column as text, null as the empty one."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if t[0] not in ("a", "s") or t == "string" else F.col(c) for c, t in df.dtypes])


def exclude(df: DataFrame, name: str) -> DataFrame:
    """[RO-06]"""
    return df.filter(F.col(name).isNotNull() & (F.col(name).cast("string") != ""))


def filtered(df: DataFrame, name: str, condition: str, types: dict[str, str] | None = None) -> DataFrame:
    """[RO-07] ``=v``, ``<v`` or ``>v`` compare by type, anything else is searched for as a pattern."""
    m = re.match(r"([=<>])(.*)", condition, re.S)
    if not m:
        return df.filter(F.col(name).cast("string").rlike(condition))
    kind = (types or {}).get(name, "str")
    left, right = F.col(name), F.lit(m[2])
    if kind in ("int", "float"):
        left, right = F.expr(f"try_cast(`{name}` AS double)"), F.expr("try_cast('" + m[2].replace("'", "''") + "' AS double)")
    elif kind == "str":
        left, right = F.lower(left.cast("string")), F.lower(right)
    return df.filter(left == right if m[1] == "=" else left < right if m[1] == "<" else left > right)


def ordered(df: DataFrame, orders: list[tuple[str, str]]) -> DataFrame:
    """[RO-08] ``[("asc", field), ...]``: each sorts what the ones before left, so the last one counts most."""
    return df.orderBy(*[F.col(n).desc() if how == "desc" else F.col(n).asc() for how, n in reversed(orders)])


def as_array(df: DataFrame, separator: str, name: str) -> DataFrame:
    """[RO-10] A text split to an array; the empty text makes an empty one."""
    parts = F.split(F.coalesce(F.col(name), F.lit("")), re.escape(separator))
    return df.withColumn(name, F.when(F.coalesce(F.col(name), F.lit("")) == "", F.array().cast("array<string>")).otherwise(parts))


def as_struct(df: DataFrame, separator: str, name: str, *names: str) -> DataFrame:
    """[RO-11] A text, or each text of an array, split to a struct; the last field takes the rest."""
    cut = lambda c: F.split(c, re.escape(separator), len(names))
    make = lambda c: F.struct(*[F.coalesce(F.get(cut(c), F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])
    is_array = dict(df.dtypes)[name].startswith("array")
    return df.withColumn(name, F.transform(name, make) if is_array else make(F.col(name)))


def decoded(df: DataFrame, *names: str) -> DataFrame:
    """[RO-18]"""
    return df.withColumns({n: tx.url_decode(F.col(n)) for n in names})


def distinct_by(df: DataFrame, name: str, *order: str) -> DataFrame:
    """[AG-06] First row of each value."""
    from quillgraph.operators.algebra import first_by

    return first_by(df, [name], *[F.col(o) for o in order])


@dataclass
class Operation:
    """One operation: pattern of its parameter, function to a table, types, pre- and postprocessing."""

    build: Callable[[object], DataFrame]
    pattern: str = ".+"
    preprocess: str = ""
    types: dict[str, str] = field(default_factory=dict)
    postprocess: list[Callable[[DataFrame], DataFrame]] = field(default_factory=list)

    def __call__(self, argument: str, query: str = "") -> DataFrame:
        """[RO-05, RO-12] The table for an argument, under the parameters of a query string.

        All excludes come first, then the filters, sorts and reshapings, each kind in
        the order given.
        """
        df = self.build(preprocessed(validated(argument, self.pattern), self.preprocess))
        df = typed(df, self.types)
        for f in self.postprocess:
            df = f(df)
        return applied(df, query, self.types)


def parameters(query: str) -> list[tuple[str, str]]:
    """``a=b&c=d`` in order; ``&`` inside of quotes does not count."""
    return [tuple(p.split("=", 1)) for p in re.findall(r'(?:[^&"]|"[^"]*")+', query) if "=" in p]


def applied(df: DataFrame, query: str, types: dict[str, str] | None = None) -> DataFrame:
    """[RO-06..08, RO-10..12]"""
    found = parameters(query)
    for name, value in found:
        if name == "exclude":
            df = exclude(df, value)
    for name, value in found:
        if name == "filter":
            df = filtered(df, *value.split(":", 1), types)
    orders = [re.fullmatch(r"(asc|desc)\((\w+)\)", v).groups() for n, v in found if n == "sort"]
    if orders:
        df = ordered(df, orders)
    for name, value in found:
        if name == "json":
            kind, separator, rest = re.fullmatch(r'(array|dict)\("((?:[^"])*)",\s*(.*)\)', value).groups()
            names = [n.strip() for n in rest.split(",")]
            df = as_array(df, separator, names[0]) if kind == "array" else as_struct(df, separator, *names)
    return df


def rendered(df: DataFrame, query: str = "", accept: str = "application/json") -> DataFrame:
    """[RO-09] One column, value: JSON rows or CSV lines; ``format`` in the query comes before the accepted type."""
    kind = dict(parameters(query)).get("format") or ("csv" if "csv" in accept else "json")
    text = plain(df)
    if kind == "json":
        return text.select(F.to_json(F.struct(*text.columns)).alias("value"))
    return text.select(F.to_csv(F.struct(*text.columns)).alias("value"))
