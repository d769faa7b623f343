"""Small-graph operators: labels from edges to nodes, groups, bridges, legal triples, evidence, plan fingerprints."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.plans.steps import written

# The types that belong to one person.
PERSONAL = ("AGE", "DATE_OF_BIRTH", "RRN", "PASSPORT_NUMBER", "DRIVER_LICENSE_NUMBER", "MOBILE_PHONE", "TELEPHONE", "EMAIL")
ORGANISATIONS = ("WORKPLACE", "DEPARTMENT", "SCHOOL")


def node_labels(edges: DataFrame, keys: list[str], source: str, target: str, pii: Column) -> DataFrame:
    """(keys, node, privacy): PII if any edge at the node is, else NON_PII; nodes without edges have no row. Nodes with many edges are combined in each task first."""
    ends = edges.select(*keys, F.explode(F.array(source, target)).alias("node"), pii.alias("__p"))
    return ends.groupBy(*keys, "node").agg(F.when(F.bool_or("__p"), F.lit("PII")).otherwise(F.lit("NON_PII")).alias("privacy"))


def bridges(edges: DataFrame, keys: list[str], source: str, target: str, pii: Column, organisation: Column) -> DataFrame:
    """Edges that aren't PII, from an organisation that some PII edge touches to a node that none does."""
    labels = node_labels(edges, keys, source, target, pii)
    s = labels.select(*keys, F.col("node").alias(source), F.col("privacy").alias("__s"))
    t = labels.select(*keys, F.col("node").alias(target), F.col("privacy").alias("__t"))
    return edges.where(~pii & organisation).join(s, [*keys, source]).join(t, [*keys, target]).where("__s = 'PII' and __t = 'NON_PII'").drop("__s", "__t")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that is reachable, by contraction.

    In a round each node points to the first of itself and its neighbours in hash order, edges move to what their ends point to, and those within vanish: a fixed share of the
    nodes goes with each round, however long a path is. Each round is a written table.
    """
    links = written(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).distinct())
    place = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    levels: list[DataFrame] = []
    while True:
        both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        level = written(both.groupBy("x").agg(F.min(place("y")).alias("m")).select("x", F.least(place("x"), "m")["v"].alias("p")))
        levels.append(level)
        moved = links.join(level.toDF("x", "px"), "x").join(level.toDF("y", "py"), "y").where("px <> py")
        links = written(moved.select(F.least("px", "py").alias("x"), F.greatest("px", "py").alias("y")).distinct())
        if not links.limit(1).count():
            break
    out = levels[0].toDF("node", "head")
    for level in levels[1:]:
        out = out.join(level.toDF("head", "up"), "head", "left").select("node", F.coalesce("up", "head").alias("head"))
    out = written(out)
    return out.join(out.groupBy("head").agg(F.min("node").alias("component")), "head").select("node", "component")


def allowed_triples(ontology: DataFrame) -> DataFrame:
    """(domain, source_type, relation, target_type) from rows of relation, sources and targets."""
    return ontology.select("domain", F.explode("sources").alias("source_type"), "relation", "targets").select("domain", "source_type", "relation", F.explode("targets").alias("target_type")).distinct()


def illegal(edges: DataFrame, triples: DataFrame, on: list[str]) -> DataFrame:
    return edges.join(triples.select(*on).distinct(), on, "left_anti")


def legal(edges: DataFrame, triples: DataFrame, on: list[str]) -> DataFrame:
    return edges.join(triples.select(*on).distinct(), on, "left_semi")


def value_group_edges(entities: DataFrame, constraints: DataFrame, relations: DataFrame, links: DataFrame) -> DataFrame:
    """(plan_id, a, b) of entities that one person or organisation stands behind: a common slot group, a same_* constraint, the sole PII owner of a personal
    attribute, or an explicit link. Its connected components within a plan are the value groups.

    entities: plan_id, entity_id, entity_type, slot_group; constraints: plan_id, kind, entity_ids; relations: plan_id, source, target, target_privacy; links:
    plan_id, name_entity_id, entity_id, link_kind.
    """
    slot = entities.where(F.coalesce("slot_group", F.lit("")) != "")
    by_slot = slot.select("plan_id", F.min("entity_id").over(Window.partitionBy("plan_id", "slot_group")).alias("a"), F.col("entity_id").alias("b"))
    same = constraints.where(F.col("kind").isin("same_persona", "same_organization")).select("plan_id", F.element_at("entity_ids", 1).alias("a"), F.explode("entity_ids").alias("b"))
    kinds = entities.select("plan_id", "entity_id", "entity_type")
    owned = (
        relations.where("target_privacy = 'PII'")
        .join(kinds.where("entity_type = 'NAME'").select("plan_id", F.col("entity_id").alias("source")), ["plan_id", "source"], "left_semi")
        .join(kinds.where(F.col("entity_type").isin(*PERSONAL)).select("plan_id", F.col("entity_id").alias("target")), ["plan_id", "target"], "left_semi")
    )
    sole = owned.groupBy("plan_id", F.col("target").alias("b")).agg(F.min("source").alias("a"), F.count_distinct("source").alias("k")).where("k = 1").select("plan_id", "a", "b")
    said = links.where("link_kind = 'personal_attribute'").groupBy("plan_id", F.col("entity_id").alias("b")).agg(F.min("name_entity_id").alias("a"), F.count_distinct("name_entity_id").alias("k"))
    return by_slot.unionByName(same).unionByName(sole).unionByName(said.where("k = 1").select("plan_id", "a", "b")).where("a <> b").distinct()


def _least(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Of each of n nodes, the least node that it reaches over the edges u, v. In a round each part hooks onto the least of its neighbours, so at most half of them are left."""
    at = np.arange(n)
    while len(u):
        low = np.minimum(u, v)
        np.minimum.at(at, u, low)
        np.minimum.at(at, v, low)
        while not np.array_equal(at, up := at[at]):
            at = up
        u, v = at[u], at[v]
        u, v = u[u != v], v[u != v]
    return at


def value_groups(entities: DataFrame, pairs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(plan_id, entity_id, value_group) and the columns `keep` of entities: the group's least entity; an entity without a tie is its own group.

    A plan is a row of its entities and pairs, and nothing but the join of both is moved: not even that where both are dealt by plan. Time and memory grow with a plan's pairs, whatever their shape.
    """
    mine = entities.groupBy("plan_id").agg(F.collect_list(F.struct("entity_id", *keep)).alias("e"))
    ties = pairs.where("a IS NOT NULL AND b IS NOT NULL").groupBy("plan_id").agg(F.collect_list(F.struct("a", "b")).alias("t"))
    kinds = [entities.schema[c] for c in ("plan_id", "entity_id", *keep)]
    schema = T.StructType([*kinds[:2], T.StructField("value_group", kinds[1].dataType), *kinds[2:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plan, e, t = batch.columns
            own, row, tied = e.flatten(), pc.list_parent_indices(e).to_numpy(), pc.list_parent_indices(t).to_numpy()
            ends = t.flatten()
            names = pa.concat_arrays([own.field(0), ends.field(0), ends.field(1)]).dictionary_encode()
            order = pc.sort_indices(names.dictionary).to_numpy().astype(np.int64)
            place = np.empty(len(order) + 1, np.int64)
            place[order], place[-1] = np.arange(len(order)), len(order)  # a null id comes last
            code = place[names.indices.fill_null(len(order)).to_numpy()]
            # nodes are numbered by row and, in it, in the order of their names
            nodes, at = np.unique(np.concatenate([row, tied, tied]) * (len(order) + 1) + code, return_inverse=True)
            k, m = len(row), len(tied)
            least = nodes[_least(at[k : k + m], at[k + m :], len(nodes))[at[:k]]] % (len(order) + 1)
            named = pa.array(np.append(order, 0)[least], mask=least == len(order))
            yield pa.RecordBatch.from_arrays([plan.take(pa.array(row)), own.field(0), names.dictionary.take(named), *(own.field(i + 1) for i in range(len(keep)))], names=schema.names)

    return mine.join(ties, "plan_id", "left").select("plan_id", "e", "t").mapInArrow(run, schema)


def group_conflicts(entities: DataFrame, groups: DataFrame, constraints: DataFrame) -> DataFrame:
    """(plan_id, value_group, code, detail): a type that a group holds twice, and occupation constraints on one field of a group whose allowed values have nothing in common."""
    typed = groups if "entity_type" in groups.columns else groups.join(entities.select("plan_id", "entity_id", "entity_type"), ["plan_id", "entity_id"])
    twice = typed.groupBy("plan_id", "value_group", "entity_type").agg(F.count("*").alias("k")).where("k > 1")
    first = twice.select("plan_id", "value_group", F.lit("VALUE_GROUP_TYPE_CONFLICT").alias("code"), F.col("entity_type").alias("detail"))
    own = constraints.where("kind = 'occupation'").select("plan_id", "constraint_id", F.when(F.coalesce("field", F.lit("")) == "", F.lit("occupation")).otherwise(F.col("field")).alias("field"), "allowed_values", F.explode("entity_ids").alias("entity_id"))
    each = own.join(groups.select("plan_id", "entity_id", "value_group"), ["plan_id", "entity_id"])
    lists = F.filter(F.transform(F.collect_set(F.struct("constraint_id", "allowed_values")), lambda x: x["allowed_values"]), F.isnotnull)
    common = F.aggregate(F.slice(lists, 2, F.greatest(F.size(lists) - 1, F.lit(0))), F.element_at(lists, 1), lambda x, y: F.array_intersect(x, y))
    empty = each.groupBy("plan_id", "value_group", "field").agg(common.alias("c")).where("size(c) = 0")
    return first.unionByName(empty.select("plan_id", "value_group", F.lit("VALUE_ALLOWED_CONFLICT").alias("code"), F.col("field").alias("detail")))


def person_links(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """(plan_id, name, entity_id, link_kind) at each named person: identity for the name itself, personal_attribute over a PII edge to a personal type, else related_context."""
    kinds = entities.select("plan_id", F.col("entity_id").alias("target"), F.col("entity_type").alias("__t"))
    names = entities.where("entity_type = 'NAME'").select("plan_id", F.col("entity_id").alias("source"))
    out = relations.join(names, ["plan_id", "source"], "left_semi").join(kinds, ["plan_id", "target"])
    kind = F.when((F.col("target_privacy") == "PII") & F.col("__t").isin(*PERSONAL), F.lit("personal_attribute")).otherwise(F.lit("related_context"))
    own = names.select("plan_id", F.col("source").alias("name"), F.col("source").alias("entity_id"), F.lit("identity").alias("link_kind"))
    return own.unionByName(out.select("plan_id", F.col("source").alias("name"), F.col("target").alias("entity_id"), kind.alias("link_kind"))).distinct()


def evidence_mode(groups: Column, positions: Column) -> Column:
    """single, adjacent, nonadjacent or unresolved, from groups of sentence ids and a map of their positions. A group counts if it has no repeats and all its ids have positions."""
    known = F.filter(groups, lambda g: (F.size(g) > 0) & (F.size(F.array_distinct(g)) == F.size(g)) & F.forall(g, lambda s: F.map_contains_key(positions, s)))
    at = F.transform(known, lambda g: F.array_sort(F.transform(g, lambda s: positions[s])))
    gapless = lambda p: F.array_max(p) - F.array_min(p) == F.size(p) - 1  # noqa: E731  positions differ, so this says that all neighbours do by 1
    return F.when(F.exists(known, lambda g: F.size(g) == 1), F.lit("single")).when(F.exists(at, gapless), F.lit("adjacent")).when(F.size(known) > 0, F.lit("nonadjacent")).otherwise(F.lit("unresolved"))


def smallest_evidence(groups: Column, positions: Column) -> Column:
    """The size of the smallest group that counts; null if none does."""
    known = F.filter(groups, lambda g: (F.size(g) > 0) & (F.size(F.array_distinct(g)) == F.size(g)) & F.forall(g, lambda s: F.map_contains_key(positions, s)))
    return F.array_min(F.transform(known, F.size))


def _digest(x: object) -> str:
    return hashlib.sha256(json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


class _Search:
    """The least certificate of a connected labelled graph over all ways to tell equal nodes apart.

    Colours are ranks, so they mean the same in graphs that differ in names only. Where a round of refinement leaves equal nodes, each of a cell is set apart in turn. Two leaves of equal certificates show an automorphism: it joins
    nodes to orbits of which one is tried, and it ends the branch that it was found in, since all of that branch is like one that was searched.
    """

    def __init__(self, label: dict[str, str], out: dict[str, list], into: dict[str, list]):
        self.label, self.out, self.into = label, out, into
        self.leaves: dict[tuple, tuple[list[str], list[str]]] = {}  # by certificate: the order of nodes, and the nodes set apart on the way
        self.best: tuple | None = None
        self.twin = {v: (tuple(sorted(out[v])), tuple(sorted(into[v]))) for v in label}  # nodes with the same neighbours can change places
        ranks = {x: i for i, x in enumerate(sorted(set(label.values())))}
        self._visit({v: ranks[x] for v, x in label.items()}, [])

    def _refined(self, colour: dict[str, int]) -> dict[str, int]:
        n = len(set(colour.values()))
        while True:
            sign = {v: (c, tuple(sorted([(e, colour[w]) for e, w in self.out[v]])), tuple(sorted([(e, colour[w]) for e, w in self.into[v]]))) for v, c in colour.items()}
            place = {x: i for i, x in enumerate(sorted(set(sign.values())))}
            colour = {v: place[x] for v, x in sign.items()}
            if len(place) == n:
                return colour
            n = len(place)

    def _leaf(self, colour: dict[str, int], path: list[str]) -> int | None:
        """Keeps the leaf; if one like it is known, joins orbits where their paths part and says how long the common path is."""
        order = sorted(colour, key=colour.get)
        found = (tuple(self.label[v] for v in order), tuple(sorted((colour[v], e, colour[w]) for v in order for e, w in self.out[v])))
        known = self.leaves.get(found)
        if known is None:
            self.leaves[found] = order, list(path)
            self.best = found if self.best is None or found < self.best else self.best
            return None
        level = next(i for i, (x, y) in enumerate(zip(known[1], path, strict=True)) if x != y)
        self.same = list(zip(known[0], order, strict=True))
        return level

    def _visit(self, colour: dict[str, int], path: list[str]) -> int | None:
        """The level to go back to, if an automorphism was found that makes what is left of the branch superfluous."""
        colour = self._refined(colour)
        cells: dict[int, list[str]] = {}
        for v, c in colour.items():
            cells.setdefault(c, []).append(v)
        open_cells = [c for c in cells if len(cells[c]) > 1]
        if not open_cells:
            return self._leaf(colour, path)
        orbit = {v: v for v in colour}

        def root(v: str) -> str:
            while orbit[v] != v:
                orbit[v] = v = orbit[orbit[v]]
            return v

        tried: list[str] = []
        cell = cells[min(open_cells, key=lambda c: (len(cells[c]), c))]
        first: dict[tuple, str] = {}
        for v in sorted(cell):
            orbit[root(v)] = root(first.setdefault(self.twin[v], v))
        for v in sorted(cell):
            if any(root(v) == root(u) for u in tried):
                continue
            tried.append(v)
            apart = {w: 2 * c + (w != v) for w, c in colour.items()}
            level = self._visit(apart, [*path, v])
            if level is not None:
                if level < len(path):
                    return level
                for x, y in self.same:  # it fixes all that was set apart before
                    orbit[root(x)] = root(y)
        return None


def _certificate(labels: tuple[str, ...], edges: tuple[tuple[int, int, str], ...]) -> tuple:
    """The least certificate of a connected graph of the nodes 0, 1, ... with these labels."""
    out: dict[int, list] = {v: [] for v in range(len(labels))}
    into: dict[int, list] = {v: [] for v in out}
    for s, t, e in edges:
        out[s].append((e, t))
        into[t].append((e, s))
    return _Search(dict(enumerate(labels)), out, into).best


#: Small parts of plans come again and again under other names; what they are is searched once a worker.
_known, KNOWN_EDGES = lru_cache(1 << 15)(_certificate), 32


def fingerprint(nodes: Iterable[tuple[str, str]], edges: Iterable[tuple[str, str, str]]) -> str:
    """A hash of a labelled graph that depends on neither names nor order: connected parts are certified one by one, with their nodes numbered by their labels and those around them. nodes: (id, label); edges: (source, target, label)."""
    label = dict(nodes)
    out: dict[str, list] = {v: [] for v in label}
    into: dict[str, list] = {v: [] for v in label}
    for s, t, e in edges:
        out[s].append((e, t))
        into[t].append((e, s))
    seen, parts = set(), []
    for start in label:
        if start in seen:
            continue
        part, todo = set(), [start]
        while todo:
            v = todo.pop()
            if v not in part:
                part.add(v)
                todo += [w for _, w in out[v]] + [w for _, w in into[v]]
        seen |= part
        around = {v: (label[v], sorted([(e, label[w]) for e, w in out[v]]), sorted([(e, label[w]) for e, w in into[v]])) for v in part}
        order = sorted(part, key=around.get)
        at = {v: i for i, v in enumerate(order)}
        ties = sorted([(at[v], at[w], e) for v in order for e, w in out[v]])
        parts.append((_known if len(ties) <= KNOWN_EDGES else _certificate)(tuple([label[v] for v in order]), tuple(ties)))
    return _digest(sorted(parts))


def plan_fingerprints(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(plan_id, fingerprint). nodes: plan_id, node, label; edges: plan_id, source, target, label and, where it counts, scene, the position of the relation's scene. A plan is a small graph; each is one row in Python. Where both are dealt by plan, nothing more is moved."""
    if "scene" in edges.columns:
        edges = edges.withColumn("label", F.concat_ws("@", "label", F.col("scene").cast("string")))
    per_node = nodes.groupBy("plan_id").agg(F.collect_list(F.struct("node", "label")).alias("nodes"))
    per_edge = edges.groupBy("plan_id").agg(F.collect_list(F.struct("source", "target", "label")).alias("edges"))
    joined = per_node.join(per_edge, "plan_id", "left")

    def rows(lists: pa.ListArray) -> Iterator[list[tuple]]:
        """The structs of each list as tuples; none of a null."""
        held, ends = list(zip(*(c.to_pylist() for c in lists.flatten().flatten()), strict=True)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy().cumsum().tolist()
        return (held[a:b] for a, b in zip([0, *ends], ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint(n, e) for n, e in zip(rows(b.column(1)), rows(b.column(2)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], names=["plan_id", "fingerprint"])

    return joined.select("plan_id", "nodes", "edges").mapInArrow(run, T.StructType([nodes.schema["plan_id"], T.StructField("fingerprint", T.StringType())]))


# A person's contact details aren't by themselves a duty to handle information.
BARRED_RELATION, BARRED_TARGETS = "INFORMATION_GOVERNANCE", ("MOBILE_PHONE", "TELEPHONE", "EMAIL")


def compatible(triples: DataFrame, subtypes: DataFrame) -> DataFrame:
    """Triples (subtype, source_type, relation, target_type) that their subtype's list of relations (subtype, relation) allows, without those of a name's contact details as information governance."""
    listed = triples.join(subtypes.select("subtype", "relation").distinct(), ["subtype", "relation"], "left_semi")
    return listed.where(~((F.col("relation") == BARRED_RELATION) & (F.col("source_type") == "NAME") & F.col("target_type").isin(*BARRED_TARGETS)))
