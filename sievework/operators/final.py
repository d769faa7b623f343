"""The last check of a finished document: one JSON text a row, every rule inside of the row, so that nothing is shuffled whatever the number of documents.

A document: sentences (sent_idx, sentence, PII_set, sent_seq, labelling_seq), entities (entity_id, entity_type, canonical_form, mentions) and relations (entity, target_entity, entity_type,
target_entity_type, relation, privacy_label). Missing keys, nulls and values of a wrong type are told apart by the variant type. Lookups by id scan the ids of one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import strip
from sievework.operators.document import INTERNAL_ID, PLACEHOLDER, TYPES, char_sequence

SENTENCE = ("sent_idx", "sentence", "PII_set", "sent_seq", "labelling_seq")
ENTITY = ("entity_id", "entity_type", "canonical_form", "mentions")
RELATION = ("entity", "target_entity", "entity_type", "target_entity_type", "relation", "privacy_label")
_ISSUE = "array<struct<code:string,target:string>>"
_SPAN = "struct<begin:bigint,end:bigint,form:string,label:string>"


def _part(x: Column, key: str) -> Column:
    return F.try_variant_get(x, f"$.{key}", "variant")


def _text(x: Column, key: str) -> Column:
    return F.when(F.schema_of_variant(_part(x, key)) == "STRING", F.try_variant_get(x, f"$.{key}", "string"))


def _number(x: Column, key: str) -> Column:
    return F.when(F.schema_of_variant(_part(x, key)) == "BIGINT", F.try_variant_get(x, f"$.{key}", "bigint"))


def _texts(x: Column, key: str) -> Column:
    return F.when(F.schema_of_variant(_part(x, key)).isin("ARRAY<STRING>", "ARRAY<VOID>"), F.try_variant_get(x, f"$.{key}", "array<string>"))


def _list(x: Column, key: str) -> Column:
    return _part(x, key).try_cast("array<variant>")


def _keys(x: Column) -> Column:
    return F.map_keys(x.try_cast("map<string,variant>"))


def _has(x: Column, keys: tuple[str, ...]) -> Column:
    return F.coalesce(F.size(F.array_except(F.array(*map(F.lit, keys)), _keys(x))) == 0, F.lit(False))


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _issue(code: str, target: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), F.coalesce(target.cast("string"), F.lit("")).alias("target"))


def _each(rows: Column, code: str, broken, target) -> Column:
    """One issue for each row that is broken."""
    return F.transform(F.filter(rows, broken), lambda x: _issue(code, target(x))).cast(_ISSUE)


def _let(value: Column, body) -> Column:
    """The body with a value that is computed once a row; a column of a lower projection may be put into a lambda by the optimiser and computed for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sorted(rows: Column, key: str) -> Column:
    return F.array_sort(F.transform(rows, lambda x: F.struct(x[key].alias("k"), x["i"].alias("i"))))


def _repeats(rows: Column, key: str) -> Column:
    """The positions (field i) of rows whose key came before, found among sorted neighbours."""

    def again(order: Column) -> Column:
        marked = F.transform(order, lambda x, n: F.struct(x["i"].alias("i"), ((n > 0) & x["k"].eqNullSafe(F.get(order, n - 1)["k"])).alias("again")))
        return F.transform(F.filter(marked, lambda y: y["again"]), lambda y: y["i"])

    return _let(_sorted(rows, key), again)


def _last(rows: Column, key: str) -> Column:
    """The positions of the last row of each key."""

    def ends(order: Column) -> Column:
        marked = F.transform(order, lambda x, n: F.struct(x["i"].alias("i"), ((n < F.size(order) - 1) & x["k"].eqNullSafe(F.get(order, n + 1)["k"])).alias("more")))
        return F.transform(F.filter(marked, lambda y: ~y["more"]), lambda y: y["i"])

    return _let(_sorted(rows, key), ends)


def _inside(y: Column, text: Column) -> Column:
    """Whether begin and end lie in the text and cut out the form."""
    cut = F.substring(text, (y["begin"] + 1).cast("int"), (y["end"] - y["begin"]).cast("int"))
    return _true((y["begin"] >= 0) & (y["begin"] < y["end"]) & (y["end"] <= F.length(text)) & (cut == y["form"]))


def _sound(spans: Column, text: Column) -> Column:
    """The spans that hold, each after the last one that did, and the number of the others."""
    state = f"struct<good:array<{_SPAN}>,bad:int>"

    def step(a: Column, y: Column) -> Column:
        before = F.coalesce(F.get(a["good"], F.size(a["good"]) - 1)["end"], F.lit(0))
        ok = _inside(y, text) & _true((y["begin"] >= before) & y["label"].isin(*TYPES) & (y["id"] == y["n"]))
        one = F.array(F.struct(y["begin"].alias("begin"), y["end"].alias("end"), y["form"].alias("form"), y["label"].alias("label")))
        return F.when(ok, F.struct(F.concat(a["good"], one).alias("good"), a["bad"].alias("bad")).cast(state)).otherwise(F.struct(a["good"].alias("good"), (a["bad"] + 1).alias("bad")).cast(state))

    return F.aggregate(spans, F.struct(F.array().cast(f"array<{_SPAN}>").alias("good"), F.lit(0).alias("bad")).cast(state), step)


def _labels(spans: Column, text: Column) -> Column:
    """The label of every character, laid out span by span; spans follow each other."""
    again = lambda label, n: F.array_repeat(label, F.greatest(n, F.lit(0)).cast("int"))
    runs = F.transform(
        spans,
        lambda y, n: F.concat(
            again(F.lit("O"), y["begin"] - F.when(n > 0, F.get(spans, n - 1)["end"]).otherwise(0)),
            F.array(F.concat(F.lit("B-"), y["label"])), again(F.concat(F.lit("I-"), y["label"]), y["end"] - y["begin"] - 1),
        ),
    )
    return F.concat(F.flatten(runs), again(F.lit("O"), F.length(text) - F.coalesce(F.get(spans, F.size(spans) - 1)["end"], F.lit(0))))


def _span_set(spans: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(spans, lambda y: F.struct(y["begin"].alias("begin"), y["end"].alias("end"), y["form"].alias("form"), y["label"].alias("label")))))


def checked(documents: DataFrame, key: str = "doc_id", text: str = "json") -> DataFrame:
    """(key, sentences, entities, relations, pii_mentions, issues): every document with its counts and the issues (code, target) it breaks.

    A text that is null, no JSON, repeats a key, or isn't an object of just the three lists is FINAL_SCHEMA; without lists or sentences FINAL_LISTS; neither is looked at further. Of equal ids the
    last one is meant wherever an id is looked up. Fields of a wrong type break the rule that reads them. A span or mention gives one issue each, other rules one a sentence, entity or relation.
    """
    def span(y: Column, n: Column) -> Column:
        return F.struct(*[_number(y, k).alias(k) for k in ("begin", "end", "id")], *[_text(y, k).alias(k) for k in ("form", "label")], n.alias("n"))

    def sentence(x: Column, i: Column) -> Column:
        listed = _list(x, "PII_set")
        return F.struct(
            i.alias("i"), _has(x, SENTENCE).alias("full"), _text(x, "sent_idx").alias("sid"), _text(x, "sentence").alias("text"), listed.isNull().alias("unlisted"),
            F.transform(F.coalesce(listed, F.array().cast("array<variant>")), span).alias("spans"), _texts(x, "sent_seq").alias("seq"), _texts(x, "labelling_seq").alias("lab"),
        )

    def mention(y: Column) -> Column:
        return F.struct(_text(y, "sent_idx").alias("sid"), _number(y, "begin").alias("begin"), _number(y, "end").alias("end"), _text(y, "form").alias("form"))

    def entity(x: Column, i: Column) -> Column:
        return F.struct(
            i.alias("i"), _has(x, ENTITY).alias("full"), _text(x, "entity_id").alias("eid"), _text(x, "entity_type").alias("type"), _text(x, "canonical_form").alias("form"),
            F.transform(F.coalesce(_list(x, "mentions"), F.array().cast("array<variant>")), mention).alias("mentions"),
        )

    def relation(x: Column, i: Column) -> Column:
        return F.struct(i.alias("i"), _has(x, RELATION).alias("full"), *[_text(x, k).alias(k) for k in RELATION])

    name = r"^(.+)_(\d+)$"
    known = lambda w, c: _true(F.map_contains_key(w["types"], c))

    def fits(w: Column, x: Column) -> Column:
        return (
            known(w, x["entity"]) & known(w, x["target_entity"]) & _true(x["entity"] != x["target_entity"]) & x["entity_type"].eqNullSafe(F.try_element_at(w["types"], x["entity"]))
            & x["target_entity_type"].eqNullSafe(F.try_element_at(w["types"], x["target_entity"])) & _true(x["privacy_label"].isin("PII", "NON_PII"))
        )

    def ends(rows: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(rows, lambda x: F.array(x["entity"], x["target_entity"]))))

    edge = lambda x: F.concat_ws("/", x["entity"], F.coalesce(x["relation"], F.lit("")), x["target_entity"])
    parsed = lambda v: {
        "ks": _keys(v), "s": F.transform(_list(v, "sentences"), sentence), "e": F.transform(_list(v, "entities"), entity), "r": F.transform(_list(v, "relations"), relation),
    }
    usable = lambda w: {
        "sg": F.transform(F.filter(w["s"], lambda x: x["full"] & x["sid"].isNotNull() & x["text"].isNotNull()), lambda x: x.withField("sound", _sound(x["spans"], x["text"]))),
        "eg": F.filter(w["e"], lambda x: x["full"]), "rg": F.filter(w["r"], lambda x: x["full"]),
    }
    ordered = lambda w: {
        "s_again": _repeats(w["sg"], "sid"), "e_again": _repeats(w["eg"], "eid"), "s_last": _last(w["sg"], "sid"), "e_last": _last(w["eg"], "eid"),
        "prefix": F.get(F.transform(F.filter(w["sg"], lambda x: x["sid"].rlike(name)), lambda x: F.regexp_extract(x["sid"], name, 1)), F.lit(0)),
    }
    sole = lambda w: {"su": F.filter(w["sg"], lambda x: F.array_contains(w["s_last"], x["i"])), "eu": F.filter(w["eg"], lambda x: F.array_contains(w["e_last"], x["i"]) & x["eid"].isNotNull())}
    named = lambda w: {
        "texts": F.map_from_entries(F.transform(w["su"], lambda x: F.struct(x["sid"], x["text"]))), "types": F.map_from_entries(F.transform(w["eu"], lambda x: F.struct(x["eid"], x["type"]))),
    }
    linked = lambda w: {
        "rf": F.transform(F.filter(w["rg"], lambda x: fits(w, x)), lambda x: x.withField("edge", edge(x))),
        "m": F.flatten(F.transform(w["eg"], lambda x: F.transform(x["mentions"], lambda y: F.struct(
            x["eid"].alias("eid"), *[y[k].alias(k) for k in ("sid", "begin", "end", "form")], _inside(y, F.try_element_at(w["texts"], y["sid"])).alias("ok"))))),
    }
    labelled = lambda w: {
        "placed": F.transform(F.filter(w["m"], lambda y: y["ok"]), lambda y, n: y.withField("n", n)), "r_again": _repeats(w["rf"], "edge"),
        "touched": ends(w["rf"]), "masked": ends(F.filter(w["rf"], lambda x: x["privacy_label"] == "PII")),
    }
    wanted = lambda w: {"want": F.flatten(F.transform(F.filter(w["eu"], lambda x: F.array_contains(w["masked"], x["eid"])), lambda x: F.transform(x["mentions"], lambda y: y.withField("label", x["type"]))))}
    sid, eid, none = lambda x: x["sid"], lambda x: x["eid"], lambda x: F.lit("")

    def misplaced(w: Column, x: Column) -> Column:
        own = F.regexp_extract(x["sid"], name, 2).try_cast("bigint").eqNullSafe(x["i"].cast("bigint")) & (F.regexp_extract(x["sid"], name, 1) == w["prefix"])
        return ~_true(own) | F.array_contains(w["s_again"], x["i"])

    def over(w: Column, y: Column) -> Column:
        return F.exists(w["placed"], lambda o: (o["n"] < y["n"]) & (o["sid"] == y["sid"]) & (o["begin"] < y["end"]) & (y["begin"] < o["end"]))

    def found(w: Column) -> Column:
        s, e = w["sg"], w["eg"]
        return F.concat(
            _each(w["s"], "FINAL_SENTENCE_SCHEMA", lambda x: ~x["full"], lambda x: x["i"]),
            _each(w["s"], "FINAL_SENTENCE_TYPES", lambda x: x["full"] & (x["sid"].isNull() | x["text"].isNull()), lambda x: x["i"]),
            _each(s, "FINAL_SENTENCE_INDEX", lambda x: misplaced(w, x), sid),
            _each(s, "FINAL_CHAR_SEQUENCE", lambda x: ~x["seq"].eqNullSafe(char_sequence(x["text"])), sid),
            _each(s, "FINAL_PLACEHOLDER", lambda x: x["text"].rlike(PLACEHOLDER), sid),
            _each(s, "FINAL_INTERNAL_ENTITY_ID", lambda x: x["text"].rlike(INTERNAL_ID), sid),
            F.flatten(F.transform(s, lambda x: F.array_repeat(_issue("FINAL_PII_SPAN", x["sid"]), x["sound"]["bad"] + x["unlisted"].cast("int")))).cast(_ISSUE),
            _each(s, "FINAL_BIO", lambda x: ~x["lab"].eqNullSafe(_labels(x["sound"]["good"], x["text"])), sid),
            _each(w["e"], "FINAL_ENTITY_SCHEMA", lambda x: ~x["full"], none),
            _each(e, "FINAL_ENTITY_ID_TYPE", lambda x: F.array_contains(w["e_again"], x["i"]) | ~_true(x["eid"].rlike("^E[1-9][0-9]*$")) | ~_true(x["type"].isin(*TYPES)), eid),
            _each(e, "FINAL_EMPTY_ENTITY", lambda x: ~_true(strip(x["form"]) != "") | (F.size(x["mentions"]) == 0), eid),
            _each(w["m"], "FINAL_MENTION_SPAN", lambda y: ~y["ok"], eid),
            _each(w["placed"], "FINAL_MENTION_OVERLAP", lambda y: over(w, y), eid),
            _each(w["r"], "FINAL_RELATION_SCHEMA", lambda x: ~x["full"], none),
            _each(w["rg"], "FINAL_RELATION_ENDPOINT", lambda x: ~fits(w, x), lambda x: F.concat_ws("/", x["entity"], x["target_entity"])),
            _each(w["rf"], "FINAL_DUPLICATE_RELATION", lambda x: F.array_contains(w["r_again"], x["i"]), lambda x: x["edge"]),
            _each(w["eu"], "FINAL_ISOLATED_ENTITY", lambda x: ~F.array_contains(w["touched"], x["eid"]), eid),
            _each(w["su"], "FINAL_MASKING_GROUP", lambda x: ~_span_set(x["spans"]).eqNullSafe(_span_set(F.filter(w["want"], lambda y: y["sid"] == x["sid"]))), sid),
        )

    only = lambda code: F.array(_issue(code, F.lit(""))).cast(_ISSUE)

    def verdict(w: Column) -> Column:
        whole = F.array_sort(w["ks"]).eqNullSafe(F.array(F.lit("entities"), F.lit("relations"), F.lit("sentences")))
        lists = w["s"].isNotNull() & w["e"].isNotNull() & w["r"].isNotNull() & _true(F.size(w["s"]) > 0)
        count = lambda c: F.when(whole & lists, c).otherwise(0).cast("long")
        return F.struct(
            count(F.size(w["su"])).alias("sentences"), count(F.size(w["eu"])).alias("entities"), count(F.size(w["rf"]) - F.size(w["r_again"])).alias("relations"),
            count(F.aggregate(w["su"], F.lit(0), lambda a, x: a + F.size(x["spans"]))).alias("pii_mentions"),
            F.when(~whole, only("FINAL_SCHEMA")).when(~lists, only("FINAL_LISTS")).otherwise(found(w)).alias("issues"),
        )

    def stage(step, kept: list[str], names: list[str]):
        def fields(x: Column) -> Column:
            new = step(x)
            names.extend([*kept, *(k for k in new if k not in kept)])
            return F.struct(*[x[k].alias(k) for k in kept if k not in new], *[c.alias(k) for k, c in new.items()])

        return fields

    w, kept = F.try_parse_json(F.col(text)), []
    for step in (parsed, usable, ordered, sole, named, linked, labelled, wanted):
        names: list[str] = []
        w, kept = _let(w, stage(step, kept, names)), names
    return documents.select(F.col(key), _let(w, verdict).alias("__x")).select(key, "__x.*")


def final_issues(documents: DataFrame, key: str = "doc_id", text: str = "json") -> DataFrame:
    """(key, code, target) of every rule that a document breaks."""
    # explode would have Spark push a copy of the whole check below the projection, as a filter for lists that aren't empty
    return checked(documents, key, text).select(key, F.explode_outer("issues").alias("x")).select(key, "x.code", "x.target").where("code IS NOT NULL")


def final_check(documents: DataFrame, key: str = "doc_id", text: str = "json") -> DataFrame:
    """Each document with its counts, the number of its issues and whether it passes."""
    return checked(documents, key, text).withColumns({"n_issues": F.size("issues").cast("long"), "passed": F.size("issues") == 0}).drop("issues")
