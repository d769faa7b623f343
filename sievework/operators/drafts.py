"""Rules over plans and drafts, and the repairs that need no model.

Rows: entities (plan_id, entity_id, entity_type), relations (plan_id, relation_id, source, target, relation, target_privacy, scene_id, context_reason), scenes (plan_id, scene_id, section_id,
ord, relation_ids), persons (plan_id, person_id, name_entity_id, role, context_kind), links (plan_id, person_id, entity_id, role, link_kind, relation_ids), segments (plan_id, sentence_id,
section_id, scene_id, kind, text). Issues are (plan_id, code, target).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import LITERALS, missing, numeric_fields, strip
from sievework.operators import document, graph
from sievework.operators.dedup import near_copy

# Words after which only certain types may stand, and prose about relations instead of facts.
TYPE_CUES = (
    (r"(?:주민등록번호)", ("RRN",)),
    (r"(?:생년월일)", ("DATE_OF_BIRTH",)),
    (r"(?:계좌번호|금융자산)", ("BANK_ACCOUNT_NUMBER", "CARD_NUMBER")),
    (r"(?<!이메일 )(?<!이메일)(?:주소)", ("ADDRESS",)),
    (r"(?:전화번호|연락처)", ("MOBILE_PHONE", "TELEPHONE", "EMAIL")),
    (r"(?:이메일)", ("EMAIL",)),
    (r"(?:부서)", ("DEPARTMENT",)),
    (r"(?:학교)", ("SCHOOL",)),
    (r"(?:전공|학과)", ("MAJOR",)),
)
PERSON_CUE = r"(?:신고인|신청인|환자|고객|지원자|상대방)"
RELATIONAL_SUFFIXES = ("에서", "에게", "으로", "로", "의", "과", "와", "을", "를", "에")
META_PROSE = r"(?:(?:관계|연결|역할|사건\s*발생)(?:을|를|이|가)?\s*(?:정의|명확|구분|설명|명시|나타(?:내|냅|냈|낸))|관계(?:이|가)다|이\s*관계(?:를|는|가|로))"
IDENTIFYING = ("AGE", "DATE_OF_BIRTH", "RRN", "PASSPORT_NUMBER", "DRIVER_LICENSE_NUMBER")
_TOKEN = r"<([A-Z][A-Z0-9_]*):(E[0-9]+)>"
_TAG = re.compile(r"<[^<>]+>")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _issue(df: DataFrame, code: str, target: Column | None = None) -> DataFrame:
    return df.select("plan_id", F.lit(code).alias("code"), (F.lit("") if target is None else target.cast("string")).alias("target"))


def _ids(df: DataFrame, column: str, pattern: str) -> DataFrame:
    bad = df.groupBy("plan_id").agg(F.count("*").alias("n"), F.count_distinct(column).alias("d"), F.bool_and(F.col(column).rlike(f"^{pattern}$")).alias("ok")).where("n <> d or not ok")
    return _issue(bad, "PLAN_ID", F.lit(column))


def plan_issues(entities: DataFrame, relations: DataFrame, scenes: DataFrame, triples: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted: plan_id, relation_count, pii_relation_target, non_pii_relation_target, non_pii_only_min, sections, required_relations; triples: source_type, relation, target_type."""
    kinds = entities.select("plan_id", "entity_id", "entity_type").distinct()
    ends = relations.join(kinds.toDF("plan_id", "source", "__s"), ["plan_id", "source"], "left").join(kinds.toDF("plan_id", "target", "__t"), ["plan_id", "target"], "left")
    known = triples.select(F.col("source_type").alias("__s"), "relation", F.col("target_type").alias("__t"), F.lit(True).alias("__legal")).distinct()
    marked = ends.join(known, ["__s", "relation", "__t"], "left").join(scenes.select("plan_id", "scene_id", F.lit(True).alias("__scene")).distinct(), ["plan_id", "scene_id"], "left")
    broken = F.col("__s").isNull() | F.col("__t").isNull() | (F.col("source") == F.col("target"))
    rules = {
        "PLAN_ENDPOINT": broken,
        "PLAN_TRIPLE": ~broken & F.col("__legal").isNull(),
        "PLAN_SCENE_CONTEXT": ~broken & (F.col("__scene").isNull() | (strip(F.coalesce("context_reason", F.lit(""))) == "")),
        "FICTIONAL_ATTRIBUTE_POLICY": ~broken & (F.col("__s") == "NAME") & (F.col("target_privacy") == "NON_PII") & F.col("__t").isin(*IDENTIFYING),
    }
    each = document.issues(marked, "plan_id", rules, F.col("relation_id"))
    twice = relations.groupBy("plan_id", "source", "relation", "target").agg(F.count("*").alias("k")).where("k > 1")
    groups = graph.node_labels(relations, ["plan_id"], "source", "target", F.col("target_privacy") == "PII")
    counted = (
        wanted.join(relations.groupBy("plan_id").agg(F.count("*").alias("n"), F.count_if(F.col("target_privacy") == "PII").alias("p"), F.count_if(F.col("target_privacy") == "NON_PII").alias("q"), F.collect_set("relation").alias("kinds")), "plan_id", "left")
        .join(groups.groupBy("plan_id").agg(F.count("*").alias("nodes"), F.count_if(F.col("privacy") == "NON_PII").alias("public")), "plan_id", "left")
        .join(entities.groupBy("plan_id").agg(F.count("*").alias("n_entities")), "plan_id", "left")
        .join(scenes.groupBy("plan_id").agg(F.collect_set("section_id").alias("has"), F.count_distinct("ord").alias("orders"), F.count_distinct("scene_id").alias("n_scenes")), "plan_id", "left")
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    whole = document.issues(
        counted, "plan_id",
        {
            "ISOLATED_ENTITY": zero("nodes") != zero("n_entities"),
            "NON_PII_ONLY_COUNT": zero("public") < F.col("non_pii_only_min"),
            "RELATION_COUNT": zero("n") != F.col("relation_count"),
            "PRIVACY_RELATION_COUNT": (zero("p") != F.col("pii_relation_target")) | (zero("q") != F.col("non_pii_relation_target")),
            "SCENE_SECTION": (F.array_sort("has") != F.array_sort("sections")) | (F.col("orders") != F.col("n_scenes")),
            "REQUIRED_RELATION_MISSING": F.size(F.array_except("required_relations", "kinds")) > 0,
        },
        F.lit(""),
    )
    owned = scenes.select("plan_id", "scene_id", F.explode("relation_ids").alias("relation_id"))
    wrong = owned.join(relations.select("plan_id", "relation_id", "scene_id"), ["plan_id", "relation_id", "scene_id"], "left_anti")
    owners = relations.join(owned.groupBy("plan_id", "relation_id").agg(F.count("*").alias("k")), ["plan_id", "relation_id"], "left").where(zero("k") != 1)
    return _union([
        _ids(entities, "entity_id", "E[1-9][0-9]*"), _ids(relations, "relation_id", "R[1-9][0-9]*"), _ids(scenes, "scene_id", "SC[1-9][0-9]*"), each,
        _issue(twice, "PLAN_DUPLICATE_EDGE", F.concat_ws("/", "source", "relation", "target")), whole, _issue(wrong, "SCENE_RELATION", F.col("relation_id")), _issue(owners, "SCENE_COVERAGE", F.col("relation_id")),
    ])


def person_issues(persons: DataFrame, links: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """Ids and names that repeat, names without a person, links that repeat or lead nowhere, identity, ownership, and actual parties without a personal relation."""
    p = persons.groupBy("plan_id").agg(F.count("*").alias("n"), F.count_distinct("person_id").alias("a"), F.count_distinct("name_entity_id").alias("b"), F.bool_and(F.col("person_id").rlike("^P[1-9][0-9]*$")).alias("ok"))
    names = entities.where("entity_type = 'NAME'").select("plan_id", "entity_id")
    mine = persons.select("plan_id", F.col("name_entity_id").alias("entity_id"))
    cover = names.join(mine, ["plan_id", "entity_id"], "left_anti").unionByName(mine.join(names, ["plan_id", "entity_id"], "left_anti"))
    j = links.join(persons.select("plan_id", "person_id", "name_entity_id"), ["plan_id", "person_id"], "left").join(entities.select("plan_id", "entity_id", "entity_type"), ["plan_id", "entity_id"], "left")
    rules = {
        "PERSON_ENTITY_LINK": F.col("name_entity_id").isNull() | F.col("entity_type").isNull() | (strip(F.coalesce("role", F.lit(""))) == ""),
        "PERSON_IDENTITY_LINK": (F.col("link_kind") == "identity") & (F.col("entity_id") != F.col("name_entity_id")),
        "PERSON_OWNERSHIP": (F.col("link_kind") == "personal_attribute") & (F.col("entity_type") == "NAME"),
    }
    each = document.issues(j, "plan_id", rules, F.col("entity_id"))
    twice = links.groupBy("plan_id", "person_id", "entity_id").agg(F.count("*").alias("k")).where("k > 1")
    identity = persons.join(links.where("link_kind = 'identity'").groupBy("plan_id", "person_id").agg(F.count("*").alias("k")), ["plan_id", "person_id"], "left").where("coalesce(k, 0) <> 1")
    cited = links.select("plan_id", "entity_id", F.explode("relation_ids").alias("relation_id"))
    ends = relations.select("plan_id", "relation_id", F.explode(F.array("source", "target")).alias("entity_id"))
    astray = cited.join(ends, ["plan_id", "relation_id", "entity_id"], "left_anti")
    touched = relations.where("target_privacy = 'PII'").select("plan_id", F.explode(F.array("source", "target")).alias("name_entity_id")).distinct()
    alone = persons.where("context_kind = 'actual_party'").join(touched, ["plan_id", "name_entity_id"], "left_anti")
    return _union([
        _issue(p.where("n <> a or n <> b or not ok"), "PERSON_ID"), _issue(cover, "PERSON_NAME_COVERAGE", F.col("entity_id")), each, _issue(twice, "PERSON_ENTITY_LINK", F.col("entity_id")),
        _issue(identity, "PERSON_IDENTITY_COVERAGE", F.col("person_id")), _issue(astray, "PERSON_LINK_RELATION", F.col("relation_id")), _issue(alone, "PERSON_PII_CONTEXT", F.col("name_entity_id")),
    ])


def _misnamed(t: Column) -> Column:
    """Whether a token that is no name stands behind a person's role; behind a particle it may, if what follows ties it to another word."""
    tied = "|".join(RELATIONAL_SUFFIXES)
    direct = t.rlike(rf"(?U){PERSON_CUE}\s*<(?!NAME:)[A-Z][A-Z0-9_]*:E[0-9]+>")
    return direct | t.rlike(rf"(?U){PERSON_CUE}\s*(?:인|은|는|이|가|을|를|:)\s*<(?!NAME:)[A-Z][A-Z0-9_]*:E[0-9]+>(?!\s*(?:{tied}))")


def draft_issues(segments: DataFrame, entities: DataFrame) -> DataFrame:
    """Of each segment: tags that are none, tokens of other types than planned, wrong types after a cue, prose about relations, literal identifiers, empty, several lines, several sentences."""
    t = F.col("text")
    tags = F.regexp_extract_all(t, F.lit(r"<[^>]+>"), F.lit(0))
    tokens = F.regexp_extract_all(t, F.lit(_TOKEN), F.lit(0))
    bare = F.regexp_replace(t, _TOKEN, "")  # ids inside tokens aren't bare
    literal = reduce(lambda a, b: a | b, [*[t.rlike(p) for p in LITERALS.values()], bare.rlike(document.INTERNAL_ID)])

    def cued(cue: str, kinds: tuple[str, ...]) -> Column:
        found = F.regexp_extract_all(t, F.lit(cue + r"\s*(?:인|은|는|이|가|을|를|:)?\s*<([A-Z][A-Z0-9_]*):E[0-9]+>"), F.lit(1))
        return F.exists(found, lambda k: ~k.isin(*kinds))

    cue = reduce(lambda a, b: a | b, [cued(*c) for c in TYPE_CUES])
    rules = {
        "UNKNOWN_TAG": F.exists(tags, lambda x: ~x.rlike(r"^<(?:[A-Z][A-Z0-9_]*:E[0-9]+|REF:C[0-9]+)>$")),
        "ENTITY_TYPE_CONTEXT": cue | _misnamed(t),
        "RELATION_META_PROSE": t.rlike(META_PROSE),
        "LITERAL_IDENTIFIER": literal,
        "EMPTY_SEGMENT": strip(t) == "",
        "MULTILINE_SEGMENT": t.rlike(r"[\n\r]"),
        "PROSE_MULTIPLE_SENTENCES": (F.col("kind") == "prose") & t.rlike(r"(?<!\d)[.!?。！？]+[\"'”’)]*\s+(?=[가-힣A-Za-z<])"),
    }
    each = document.issues(segments, "plan_id", rules, F.col("sentence_id"))
    used = segments.select("plan_id", "sentence_id", F.explode(tokens).alias("tok")).select("plan_id", "sentence_id", F.regexp_extract("tok", _TOKEN, 1).alias("entity_type"), F.regexp_extract("tok", _TOKEN, 2).alias("entity_id"))
    known = entities.select("plan_id", "entity_id", "entity_type")
    wrong = used.join(known, ["plan_id", "entity_id", "entity_type"], "left_anti")
    missing = known.join(used.select("plan_id", "entity_id").distinct(), ["plan_id", "entity_id"], "left_anti")
    return each.unionByName(_issue(wrong, "PLACEHOLDER_TYPE_ID", F.concat_ws(":", "entity_type", "entity_id"))).unionByName(_issue(missing, "MISSING_ENTITY_MENTION", F.col("entity_id")))


def suspected_pairs(segments: DataFrame, relations: DataFrame) -> DataFrame:
    """(plan_id, sentence_id, a, b): entities that stand in one sentence without a planned relation between them; an observation, not an issue."""
    used = segments.select("plan_id", "sentence_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(2)))).alias("e"))
    both = used.toDF("plan_id", "sentence_id", "a").join(used.toDF("plan_id", "sentence_id", "b"), ["plan_id", "sentence_id"]).where("a < b")
    planned = relations.select("plan_id", F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")).distinct()
    return both.join(planned, ["plan_id", "a", "b"], "left_anti").select("plan_id", "sentence_id", "a", "b")


def _matches(text: str, surfaces: ahocorasick.Automaton) -> Iterator[tuple[int, int, str]]:
    """(begin, end, token) of what is replaced: at each place the longest surface, leftmost first, none inside a tag that begins there or before; a tag goes only if it is a surface."""
    tags = {m.start(): m.end() for m in _TAG.finditer(text)}
    longest: dict[int, tuple[int, str]] = {}
    for last, (n, token) in surfaces.iter(text):
        begin = last - n + 1
        if begin not in longest or longest[begin][0] < last + 1:
            longest[begin] = last + 1, token
    at = 0
    for begin in sorted(tags.keys() | longest.keys()):
        if begin < at:
            continue
        if begin in tags:
            at = tags[begin]
            if own := surfaces.get(text[begin:at], None):  # a tag that is itself a value
                yield begin, at, own[1]
        else:
            at, token = longest[begin]
            yield begin, at, token


def with_tokens(texts: DataFrame, surfaces: DataFrame, text: str = "text") -> DataFrame:
    """Replaces known values in a text by their tokens, longest first from left to right; a value of two entities stays, and so do tags. surfaces: plan_id, surface, token.

    All values of a text are one automaton, so its cost is the text's length and the values', not their product. A plan's values come to its texts as one row. A text that is null, or without values, stays as it is.
    """
    sole = surfaces.where("surface <> ''").groupBy("plan_id", "surface").agg(F.min("token").alias("token"), F.count_distinct("token").alias("k")).where("k = 1")
    per = sole.groupBy("plan_id").agg(F.array_sort(F.collect_list(F.struct("surface", "token"))).alias("__m"))
    joined = texts.join(per, "plan_id", "left")
    schema, place = joined.drop("__m").schema, joined.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, machine = None, None
        for b in batches:
            out = []
            for t, pairs in zip(b.column(place).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                if t is None or not pairs:
                    out.append(t)
                    continue
                if pairs != last:
                    last, machine = pairs, ahocorasick.Automaton()
                    for x in pairs:
                        machine.add_word(x["surface"], (len(x["surface"]), x["token"]))
                    machine.make_automaton()
                pieces, at = [], 0
                for begin, end, token in _matches(t, machine):
                    pieces += [t[at:begin], token]
                    at = end
                out.append("".join([*pieces, t[at:]]))
            cols = [*b.columns[: b.num_columns - 1]]
            cols[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return joined.mapInArrow(run, schema).select(*texts.columns)


def typed_ids(segments: DataFrame, entities: DataFrame) -> DataFrame:
    """Bare ids of known entities (E12, not inside a token) become <TYPE:E12>."""
    kinds = entities.groupBy("plan_id").agg(F.map_from_entries(F.collect_list(F.struct("entity_id", "entity_type"))).alias("__k"))
    pattern = r"(?U)(?<![\w:])E[1-9][0-9]*(?![A-Za-z0-9_])"
    joined = segments.join(kinds, "plan_id", "left")
    ids = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    token = lambda e: F.coalesce(F.concat(F.lit("<"), F.element_at("__k", e), F.lit(":"), e, F.lit(">")), e)
    gaps = F.split("text", pattern, -1)
    whole = F.concat(F.array_join(F.zip_with(F.slice(gaps, F.lit(1), F.size(ids)), F.transform(ids, token), lambda g, k: F.concat(g, k)), ""), F.element_at(gaps, -1))
    return joined.withColumn("text", whole).drop("__k")


def additions(new: DataFrame, old: DataFrame) -> DataFrame:
    """Adds outcome to new sentences (plan_id, ord, text): identifier (tags or literal values), repeat (near copy of an old or an earlier new sentence), conflict (another number for a known field) or kept."""
    bare = lambda c: F.regexp_replace(F.regexp_replace(c, r"<[^>]+>|\{josa:[^}]+\}", ""), r"(?U)\s+", "")
    literal = reduce(lambda a, b: a | b, [F.col("text").rlike(p) for p in LITERALS.values()])
    flagged = new.withColumns({"__id": F.contains("text", F.lit("<")) | F.contains("text", F.lit(">")) | literal, "__key": bare(F.col("text"))})
    earlier = old.select("plan_id", F.lit(-1).alias("__o"), bare(F.col("text")).alias("__prev"), F.col("text").alias("__raw")).unionByName(flagged.where("not __id").select("plan_id", F.col("ord").cast("int").alias("__o"), F.col("__key").alias("__prev"), F.col("text").alias("__raw")))
    pairs = flagged.where("not __id").join(earlier, "plan_id").where("__o < ord")
    mine, theirs = numeric_fields(F.col("text")), numeric_fields(F.col("__raw"))
    clash = F.exists(F.map_keys(mine), lambda k: F.coalesce(F.element_at(theirs, k) != F.element_at(mine, k), F.lit(False)))
    seen = pairs.groupBy("plan_id", "ord").agg(F.bool_or(near_copy(F.col("__key"), F.col("__prev"))).alias("__rep"), F.bool_or(clash).alias("__clash"))
    outcome = F.when(F.col("__id"), F.lit("identifier")).when(F.col("__rep"), F.lit("repeat")).when(F.col("__clash"), F.lit("conflict")).otherwise(F.lit("kept"))
    return flagged.join(seen, ["plan_id", "ord"], "left").withColumn("outcome", outcome).drop("__id", "__key", "__rep", "__clash")


def role_values(entities: DataFrame, choices: DataFrame, serial: Column) -> DataFrame:
    """Adds value: for a type with a list of choices (entity_type, options), the option at (serial + how many of the type came before) modulo their number."""
    nth = F.row_number().over(Window.partitionBy("plan_id", "entity_type").orderBy("entity_id")) - 1
    joined = entities.withColumn("__n", nth).join(choices, "entity_type", "left")
    return joined.withColumn("value", F.get("options", F.pmod(serial + F.col("__n"), F.size("options")).cast("int"))).drop("__n", "options")


def split_sentences(segments: DataFrame) -> DataFrame:
    """(plan_id, position, sentence_id, text): prose segments one sentence each; the first part keeps the id, the others get the next numbers of the plan."""
    from sievework.functions.text import sentences

    lines = F.filter(F.transform(F.split("text", r"\r?\n"), strip), lambda x: x != "")
    parts = F.when(F.col("kind") == "prose", F.flatten(F.transform(F.split("text", r"\r?\n"), sentences))).otherwise(lines)
    whole = F.when(F.size(parts) < 2, F.array("text")).otherwise(parts)  # a segment of one sentence stays as it is
    each = segments.select("plan_id", F.col("position").alias("__p"), "sentence_id", F.posexplode(whole).alias("__i", "text"))
    top = F.max(F.regexp_extract("sentence_id", r"^S([0-9]+)$", 1).try_cast("long")).over(Window.partitionBy("plan_id"))
    order = Window.partitionBy("plan_id").orderBy("__p", "__i")
    extra = F.sum((F.col("__i") > 0).cast("int")).over(order)
    out = each.withColumns({"__top": top, "__x": extra, "position": F.row_number().over(order) - 1})
    return out.select("plan_id", "position", F.when(F.col("__i") == 0, F.col("sentence_id")).otherwise(F.concat(F.lit("S"), F.col("__top") + F.col("__x"))).alias("sentence_id"), "text")


# The two forms of an address, each a list of parts; a part is a path, or a number with its sub-number.
_ROAD = ("sido", "sigungu", "road_address.road_name", ("road_address.building_main_no", "road_address.building_sub_no"), "detail_address.building_name", "detail_address.detail_text")
_LOT = ("sido", "sigungu", "legal_area.eupmyeondong", "legal_area.ri", ("jibun_address.jibun_main_no", "jibun_address.jibun_sub_no"), "detail_address.building_name", "detail_address.detail_text")
_AREA = ("sido", "sigungu", "legal_area.eupmyeondong", "detail_address.detail_text")


def address(a: str = "address", key: Column | None = None, nested: bool = True) -> Column:
    """One line of an address. A text (nested=False) is trimmed. Of an object, the form by road needs a road and a number, the form by lot a number; a hash of `key` picks one of those there are, and
    without any the area stands alone. Parts that are missing are left out, a sub-number of 0 too; a town in which the district ends isn't repeated; lots on a mountain are marked."""
    if not nested:
        return strip(F.col(a))

    def part(path: str | tuple[str, str]) -> Column:
        if isinstance(path, tuple):
            sub = F.when(F.col(f"{a}.{path[1]}") != "0", part(path[1]))
            return F.concat(part(path[0]), F.coalesce(F.concat(F.lit("-"), sub), F.lit("")))
        value = F.col(f"{a}.{path}").cast("string")
        return F.when(~missing(value), strip(value))

    def line(form: tuple, change: dict) -> Column:
        return F.concat_ws(" ", *[change.get(p, part(p)) for p in form])

    town, lot = part(_LOT[2]), part(_LOT[4])
    seen = F.coalesce(part("sigungu").endswith(town), F.lit(False))
    hill = F.when(F.col(f"{a}.jibun_address.is_mountain"), F.lit("산")).otherwise(F.lit(""))
    forms = F.array(
        F.when(part(_ROAD[2]).isNotNull() & part(_ROAD[3]).isNotNull(), line(_ROAD, {})),
        F.when(lot.isNotNull(), line(_LOT, {_LOT[2]: F.when(~seen, town), _LOT[4]: F.concat(hill, lot)})),
    )
    there = F.filter(forms, lambda x: x.isNotNull())
    which = F.pmod(F.xxhash64(F.lit(0) if key is None else key), F.greatest(F.size(there), F.lit(1))).cast("int")
    return F.coalesce(F.get(there, which), line(_AREA, {}))


def with_neighbours(segments: DataFrame, keys: list[str], order: str, text: str = "text") -> DataFrame:
    """Adds before and after: the text of the rows next to a row in its group of keys, null at the ends."""
    w = Window.partitionBy(*keys).orderBy(order)
    return segments.withColumns({"before": F.lag(text).over(w), "after": F.lead(text).over(w)})
