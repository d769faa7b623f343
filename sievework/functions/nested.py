"""Nested JSON in the row: canonical text and digest of values of any shape, and schemas compiled to one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is evaluated once, whatever the number of places that read it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def kind(v: Column) -> Column:
    """object, array, string, integer, number, boolean or null; a null column is null."""
    t = F.schema_of_variant(v)
    return (
        F.when(t.startswith("OBJECT"), F.lit("object")).when(t.startswith("ARRAY"), F.lit("array")).when(t == "STRING", F.lit("string")).when(t == "BOOLEAN", F.lit("boolean")).when(t == "VOID", F.lit("null"))
        # what fits 64 bits is BIGINT if it was written as an integer, and a decimal without places if not
        .when((t == "BIGINT") | t.rlike(r"^DECIMAL\([0-9]+,0\)$") & (F.abs(F.try_variant_get(v, "$", "decimal(38,0)")) > (1 << 63) - 1), F.lit("integer")).when(t.isNotNull(), F.lit("number"))
    )


def float_text(c: Column) -> Column:
    """A finite double with the fewest digits that tell it apart, as JSON writers in Python put it: positional from 1e-4 to under 1e16, else with an exponent of two digits at least."""
    text = c.cast("string")
    mantissa, power = F.regexp_extract(text, r"^-?([0-9.]+)", 1), F.regexp_extract(text, r"E(-?[0-9]+)$", 1)
    whole, part = F.substring_index(mantissa, ".", 1), F.substring_index(mantissa, ".", -1)
    shift = F.when(power == "", F.lit(0)).otherwise(power.cast("int"))
    first = F.length(F.regexp_extract(F.concat(whole, part), "^0*", 0))  # digits before the first that counts
    digits = F.regexp_replace(F.regexp_replace(F.concat(whole, part), "^0+", ""), "0+$", "")

    def written(x: Column) -> Column:
        d, e = x["d"], x["e"]
        n = F.length(d)
        zeros = lambda k: F.repeat(F.lit("0"), k)
        fixed = (
            F.when(e >= n - 1, F.concat(d, zeros(e - n + 1), F.lit(".0")))
            .when(e >= 0, F.concat(F.substring(d, F.lit(1), e + 1), F.lit("."), F.substring(d, e + 2, n)))
            .otherwise(F.concat(F.lit("0."), zeros(-e - 1), d))
        )
        tail = F.when(n > 1, F.concat(F.lit("."), F.substring(d, F.lit(2), n))).otherwise(F.lit(""))
        raised = F.concat(F.substring(d, 1, 1), tail, F.when(e < 0, F.lit("e-")).otherwise(F.lit("e+")), F.lpad(F.abs(e).cast("string"), F.greatest(F.lit(2), F.length(F.abs(e).cast("string"))), F.lit("0")))
        return F.when(d == "", F.lit("0.0")).when((e >= -4) & (e < 16), fixed).otherwise(raised)

    size = let(F.struct(digits.alias("d"), (F.length(whole) - 1 - first + shift).alias("e")), written)
    return F.concat(F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")), size)


def quoted(c: Column) -> Column:
    """A JSON string: quotes, backslashes and controls escaped, all else as it is."""
    plain = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    escaped = plain
    short = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}
    for k in range(32):
        escaped = F.replace(escaped, F.lit(chr(k)), F.lit(short.get(k, f"\\u{k:04x}")))
    return F.concat(F.lit('"'), F.when(c.rlike(r"[\x00-\x1f]"), escaped).otherwise(plain), F.lit('"'))


def canonical_json(v: Column, depth: int = 10) -> Column:
    """Compact JSON of a variant with sorted keys, no blanks and characters as they are; numbers as Python writes them. A value nested deeper than `depth` is an error, null gives null.

    Objects and arrays are both lists of (key, value), so one expression a level does for both.
    """
    scalar = lambda x, k: (
        F.when(k == "string", quoted(F.try_variant_get(x, "$", "string"))).when(k == "number", float_text(F.try_variant_get(x, "$", "double"))).when(k == "null", F.lit("null"))
        .when(k == "boolean", F.try_variant_get(x, "$", "string")).otherwise(F.try_variant_get(x, "$", "decimal(38,0)").cast("string"))
    )
    row = "array<struct<k:string,v:variant>>"

    def text(x: Column, left: int) -> Column:
        def known(k: Column) -> Column:
            if not left:
                return F.when(k.isin("object", "array"), F.raise_error(F.lit(f"a value is nested deeper than {depth}"))).otherwise(scalar(x, k))
            members = F.map_entries(F.try_variant_get(x, "$", "map<string,variant>"))
            named = F.transform(members, lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v")))
            listed = F.transform(F.try_variant_get(x, "$", "array<variant>"), lambda e: F.struct(F.lit(None).cast("string").alias("k"), e.alias("v")))
            parts = F.when(k == "object", F.array_sort(named, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))).otherwise(listed).cast(row)
            inner = F.array_join(F.transform(parts, lambda e: F.concat(F.when(e["k"].isNotNull(), F.concat(quoted(e["k"]), F.lit(":"))).otherwise(F.lit("")), text(e["v"], left - 1))), ",")
            first, last = (F.when(k == "object", F.lit(a)).otherwise(F.lit(b)) for a, b in ("{[", "}]"))
            return F.when(k.isin("object", "array"), F.concat(first, inner, last)).otherwise(scalar(x, k))  # `inner` stands here once, or levels would double it

        return let(kind(x), known)

    return F.when(v.isNotNull(), text(v, depth))


def digest(v: Column, depth: int = 10) -> Column:
    """sha256 of the canonical JSON of a variant."""
    return F.sha2(canonical_json(v, depth), 256)


_PATHS = "array<string>"


def violations(v: Column, schema: dict) -> Column:
    """array<string> of where a variant departs from a schema of type, enum, pattern, properties (all required, no others), items, minItems, maxItems and anyOf: a code and a path each, in the order of the schema.

    The schema becomes one expression; a value of a wrong type, out of its enum or with other keys than its own isn't looked into. A null column, which is no JSON, is SCHEMA_JSON.
    """
    none = F.array().cast(_PATHS)

    def issue(code: str, path: Column) -> Column:
        return F.array(F.concat(F.lit(f"{code} "), path)).cast(_PATHS)

    def check(x: Column, s: dict, path: Column) -> Column:
        if "anyOf" in s:
            fits = [F.size(check(x, b, path)) == 0 for b in s["anyOf"]]
            return F.when(_any(fits), none).otherwise(issue("SCHEMA_ANY_OF", path))
        wanted = s["type"] if isinstance(s["type"], list) else [s["type"]]

        def known(k: Column) -> Column:
            wrong = ~k.isin(*wanted)
            if "enum" in s:
                texts = [e for e in s["enum"] if isinstance(e, str)]
                among = (k == "string") & F.coalesce(F.try_variant_get(x, "$", "string").isin(*texts), F.lit(False)) if texts else F.lit(False)
                wrong = wrong | ~(among | ((k == "null") & F.lit(None in s["enum"])))
            out = none
            if "string" in wanted and "pattern" in s:
                out = F.when((k == "string") & ~F.try_variant_get(x, "$", "string").rlike(rf"\A(?:{s['pattern']})\z"), issue("SCHEMA_PATTERN", path)).otherwise(out)
            if "object" in wanted:
                props = s["properties"]
                own = lambda m: F.when(
                    F.array_sort(F.map_keys(m)) != F.array(*[F.lit(p) for p in sorted(props)]).cast(_PATHS), issue("SCHEMA_KEYS", path)
                ).otherwise(F.concat(none, *[check(F.element_at(m, F.lit(p)), t, F.concat(path, F.lit(f".{p}"))) for p, t in props.items()]))
                out = F.when(k == "object", let(F.try_variant_get(x, "$", "map<string,variant>"), own)).otherwise(out)
            if "array" in wanted:
                def rows(items: Column) -> Column:
                    short = F.size(items) < s.get("minItems", 0)
                    long = F.size(items) > s["maxItems"] if "maxItems" in s else F.lit(False)
                    each = F.flatten(F.transform(items, lambda y, i: check(y, s["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
                    return F.concat(F.when(short | long, issue("SCHEMA_ARRAY_LENGTH", path)).otherwise(none), each)

                out = F.when(k == "array", let(F.try_variant_get(x, "$", "array<variant>"), rows)).otherwise(out)
            return F.when(wrong, issue("SCHEMA_TYPE", path)).otherwise(out)

        return let(kind(x), known)

    return F.when(v.isNull(), issue("SCHEMA_JSON", F.lit("$"))).otherwise(check(v, schema, F.lit("$")))


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out
