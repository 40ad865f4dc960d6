"""Lineage graph over studies: nodes, edges, lineage, issues and counts as tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed
from .groups import keyed_join

# Node types and their tiers.
TIERS = {"Objective": 0, "Endpoint": 1, "Regulatory": 1, "TLF": 2, "ADaM": 3, "SDTM": 4}
REG_NODE = "reg:ICH-E3"


def normal_id(c: Column | str) -> Column:
    """Output id without its type prefix, for matching."""
    return F.upper(F.regexp_replace(F.col(c) if isinstance(c, str) else c, "^[TLFtlf]-", ""))


def _node(df: DataFrame, kind: str, id_: Column, label: Column, title: Column | None = None, status: Column | None = None,
          unresolved: Column | None = None, absent: Column | None = None) -> DataFrame:
    no = F.lit(None).cast("string")
    return df.select(
        "study_id", id_.alias("id"), F.lit(kind).alias("type"), F.lit(TIERS[kind]).alias("tier"), label.alias("label"),
        (title if title is not None else label).alias("title"), (status if status is not None else no).alias("status"),
        (unresolved if unresolved is not None else F.lit(False)).alias("unresolved"), (absent if absent is not None else F.lit(False)).alias("absent"))


def _domains(adam: DataFrame) -> DataFrame:
    return adam.select("study_id", "dataset", F.explode("sdtm_source").alias("d")).select("study_id", "dataset", F.upper("d").alias("domain")).distinct()


def tlf_adam(tlfs: DataFrame, adam_uses: DataFrame, adam: DataFrame) -> DataFrame:
    """Output to data set: the authoritative used-by list, and declared needs only for outputs it never names.

    ``adam_uses`` is (study_id, dataset, table_id), the used-by lists in long form. A
    listed id may be the final or the candidate id, with or without type prefix.
    """
    names = F.array(normal_id("candidate_id"), normal_id("final_id"))
    ids = tlfs.select("study_id", "candidate_id", F.explode(names).alias("__id")).filter(F.col("__id").isNotNull())
    listed = keyed_join(ids, adam_uses.select("study_id", "dataset", normal_id("table_id").alias("__id")).distinct(), ["study_id", "__id"], "inner").select(
        "study_id", "candidate_id", "dataset").distinct()
    declared = tlfs.select("study_id", "candidate_id", F.explode("req_adam").alias("dataset")).withColumn("dataset", F.upper("dataset"))
    # the listed pairs as they are, so that both uses share one exchange
    fallback = keyed_join(declared, listed.select("study_id", "candidate_id"), ["study_id", "candidate_id"], "left_anti")
    known = keyed_join(fallback, adam.select("study_id", "dataset").distinct(), ["study_id", "dataset"], "left_semi").distinct()
    return listed.unionByName(known)


def unbridged(tlfs: DataFrame, bridge: DataFrame, adam: DataFrame) -> DataFrame:
    """Raw domains an output declares but does not reach through its data sets."""
    reached = keyed_join(bridge, _domains(adam), ["study_id", "dataset"], "inner").select("study_id", "candidate_id", "domain")
    declared = tlfs.select("study_id", "candidate_id", F.explode("req_sdtm").alias("domain")).withColumn("domain", F.upper("domain"))
    return keyed_join(declared, reached, ["study_id", "candidate_id", "domain"], "left_anti").distinct()


def mark_absent(declared: DataFrame, adam: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """(study_id, domain, absent): absent where only declared; a real source or an inventory entry clears the mark."""
    parts = [declared.select("study_id", "domain", F.lit(True).alias("a")), _domains(adam).select("study_id", "domain", F.lit(False).alias("a"))]
    out = reduce(DataFrame.unionByName, parts).groupBy("study_id", "domain").agg(F.bool_and("a").alias("absent"))
    if inventory is None:
        return out
    have = inventory.select("study_id", F.upper("domain").alias("domain")).distinct().withColumn("__have", F.lit(True))
    return keyed_join(out, have, ["study_id", "domain"]).withColumn("absent", F.col("absent") & F.col("__have").isNull()).drop("__have")


def build_nodes(objectives: DataFrame, endpoints: DataFrame, tlfs: DataFrame, adam: DataFrame, adam_uses: DataFrame,
                inventory: DataFrame | None = None) -> DataFrame:
    """All nodes, one per study and id."""
    bridge = tlf_adam(tlfs, adam_uses, adam)
    sdtm = mark_absent(unbridged(tlfs, bridge, adam), adam, inventory)
    cite = tlfs.filter(F.col("regulatory_rule").isNotNull()).select("study_id").distinct()
    parts = [
        _node(objectives, "Objective", F.concat(F.lit("obj:"), "objective_id"), F.col("objective_id"), F.coalesce("text", "objective_id")),
        _node(endpoints, "Endpoint", F.concat(F.lit("end:"), "endpoint_id"), F.col("endpoint_id"), F.coalesce("text", "endpoint_id"), unresolved=~F.col("RESOLVED")),
        _node(cite, "Regulatory", F.lit(REG_NODE), F.lit("ICH E3")),
        _node(tlfs, "TLF", F.concat(F.lit("tlf:"), "candidate_id"), F.coalesce("final_id", "candidate_id"), F.coalesce("title", "candidate_id"), F.col("status")),
        _node(adam, "ADaM", F.concat(F.lit("adam:"), "dataset"), F.col("dataset")),
        _node(sdtm, "SDTM", F.concat(F.lit("sdtm:"), "domain"), F.col("domain"), absent=F.col("absent")),
    ]
    # ids differ between types by prefix, so repeats can only be copies within one type
    return reduce(DataFrame.unionByName, parts).dropDuplicates(["study_id", "id"])


def build_edges(objectives: DataFrame, endpoints: DataFrame, tlfs: DataFrame, adam: DataFrame, adam_uses: DataFrame) -> DataFrame:
    """All edges whose two ends exist: obj-end, end-tlf, obj-tlf, reg-tlf, tlf-adam, adam-sdtm and dashed tlf-sdtm.

    An objective leads straight to an output only where the output names no endpoint.
    """
    def edge(df, src, dst, kind, dashed=False, rule=None):
        return df.select("study_id", src.alias("source"), dst.alias("target"), F.lit(kind).alias("kind"), F.lit(dashed).alias("dashed"),
                         (rule if rule is not None else F.lit(None).cast("string")).alias("rule"))

    p = lambda prefix, c: F.concat(F.lit(prefix), F.col(c))
    tlf = p("tlf:", "candidate_id")
    obj_keys, end_keys = objectives.select("study_id", "objective_id").distinct(), endpoints.select("study_id", "endpoint_id").distinct()
    bridge = checkpointed(tlf_adam(tlfs, adam_uses, adam))  # three kinds of edge read it
    obj_end = keyed_join(endpoints, obj_keys, ["study_id", "objective_id"], "left_semi")
    end_tlf = keyed_join(tlfs.select("study_id", "candidate_id", F.explode("endpoint_ids").alias("endpoint_id")), end_keys, ["study_id", "endpoint_id"], "left_semi")
    obj_tlf = keyed_join(tlfs.filter(F.size("endpoint_ids") == 0).select("study_id", "candidate_id", F.explode("objective_ids").alias("objective_id")),
                         obj_keys, ["study_id", "objective_id"], "left_semi")
    repeated = [
        edge(obj_end, p("obj:", "objective_id"), p("end:", "endpoint_id"), "obj-end"),
        edge(end_tlf, p("end:", "endpoint_id"), tlf, "end-tlf"),
        edge(obj_tlf, p("obj:", "objective_id"), tlf, "obj-tlf"),
        edge(tlfs.filter(F.col("regulatory_rule").isNotNull()), F.lit(REG_NODE), tlf, "reg-tlf", rule=F.col("regulatory_rule")),
    ]
    once = [  # each a distinct table already
        edge(bridge, tlf, p("adam:", "dataset"), "tlf-adam"),
        edge(_domains(adam), p("adam:", "dataset"), p("sdtm:", "domain"), "adam-sdtm"),
        edge(unbridged(tlfs, bridge, adam), tlf, p("sdtm:", "domain"), "tlf-sdtm", dashed=True),
    ]
    return reduce(DataFrame.unionByName, [reduce(DataFrame.unionByName, repeated).distinct(), *once])


#: Hops in one plan before paths are doubled: one more than the tiers of a trace graph lie apart.
_HOPS = 5
#: The kinds of node a walk tells apart, by prefix; all others are one more kind.
_PREFIXES = ("obj:", "end:", "reg:", "tlf:", "adam:", "sdtm:")
#: The lowest bits of a code: the direction of the walk, and with it the kind.
_UP, _KIND = 1, 15


def _code(node: Column, seed: int) -> Column:
    """64 bits for a node of a study, the lowest for the direction and three for the kind; a null is a value of its own, which matches itself."""
    study, kind = F.col("study_id"), F.lit(0)
    for i, prefix in enumerate(_PREFIXES, 1):
        kind = F.when(node.startswith(prefix), F.lit(2 * i)).otherwise(kind)
    return F.xxhash64(F.lit(seed), study.isNull(), study, node.isNull(), node).bitwiseAND(F.lit(~_KIND)).bitwiseOR(kind.cast("long"))


def _coded_nodes(edges: DataFrame, roots: DataFrame) -> tuple[DataFrame, int]:
    """(code, study_id, node) for all ends of edges and all roots, and the seed under which no two nodes share a code."""
    ends = edges.select("study_id", F.explode(F.array("source", "target")).alias("node")).unionByName(roots.select("study_id", F.col("id").alias("node"))).distinct()
    for seed in count():
        nodes = checkpointed(ends.select(_code(F.col("node"), seed).alias("code"), "study_id", "node"))
        if nodes.groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            return nodes, seed


def _hop(frontier: DataFrame, step: DataFrame) -> DataFrame:
    """(root, node) one step on."""
    return frontier.join(step.withColumnRenamed("node", "__node"), F.col("node") == F.col("__node")).select("root", F.col("next").alias("node")).distinct()


def _reach(edges: DataFrame, roots: DataFrame, directions: Sequence[str]) -> DataFrame:
    """(study_id, root, direction, node) for all nodes on directed paths from the roots, all directions in one walk.

    Nodes travel as codes of 8 bytes, proved to be different, and get their texts back at the end. The first hops make one plan; each reads only the edges
    that leave a kind of node to which the hops so far can have led, and a node met again on a longer path is dropped after them. If the last of these hops
    still finds nodes, paths are doubled: every round joins the nodes found with all paths of up to 2, 4, 8, ... edges, so the rounds grow with the logarithm
    of the longest path; a cycle brings nothing new and ends.
    """
    e = checkpointed(edges.select("study_id", "source", "target"))
    nodes, seed = _coded_nodes(e, roots)
    up, kind = lambda c: F.col(c).bitwiseOR(F.lit(_UP)), lambda c: F.col(c).bitwiseAND(F.lit(_KIND)).cast("int")
    turns = {"descendant": F.struct(F.col("s").alias("node"), F.col("t").alias("next")), "ancestor": F.struct(up("t").alias("node"), up("s").alias("next"))}
    links = e.select(_code(F.col("source"), seed).alias("s"), _code(F.col("target"), seed).alias("t")).select(F.inline(F.array(*[turns[d] for d in directions])))
    # the kind is a column of its own: a filter on the node itself would be carried over to the nodes found, which then are not the same for each of their uses
    step = checkpointed(links.withColumn("kind", kind("node")))
    names = roots.select(_code(F.col("id"), seed).alias("root"), F.col("id").alias("__name")).distinct()
    level = names.select("root", F.explode(F.array(*[up("root") if d == "ancestor" else F.col("root") for d in directions])).alias("node"))

    leads = {(r["a"], r["b"]) for r in step.select(F.col("kind").alias("a"), kind("next").alias("b")).distinct().collect()}  # a pair of kinds each, 98 at most
    here, levels = {r["a"] for r in level.select(kind("node").alias("a")).distinct().collect()}, []
    while len(levels) < _HOPS and (leaving := sorted({a for a, _ in leads} & here)):
        level = _hop(level, step.filter(F.col("kind").isin(leaving)))
        levels.append(level.withColumn("__last", F.lit(len(levels))))
        here = {b for a, b in leads if a in leaving}
    if not levels:
        levels = [level.filter(F.lit(False)).withColumn("__last", F.lit(0))]
    found = checkpointed(reduce(DataFrame.unionByName, levels).groupBy("root", "node").agg(F.max("__last").alias("__last")))
    ended = not {a for a, _ in leads} & here or found.filter(F.col("__last") == _HOPS - 1).isEmpty()
    found = found.drop("__last")
    jump = step.drop("kind") if ended else checkpointed(step.drop("kind").distinct())
    while not ended:
        new = checkpointed(_hop(found, jump).join(found, ["root", "node"], "left_anti"))
        ended = new.isEmpty()
        if not ended:
            found = found.unionByName(new)
            longer = _hop(jump.select(F.col("node").alias("root"), F.col("next").alias("node")), jump)
            jump = checkpointed(jump.unionByName(longer.select(F.col("root").alias("node"), F.col("node").alias("next"))).distinct())
    texts = found.select("root", F.col("node").bitwiseAND(F.lit(~_UP)).alias("code"), F.col("node").bitwiseAND(F.lit(_UP)).alias("__up")).join(nodes, "code").join(names, "root")
    return texts.select("study_id", F.col("__name").alias("root"), F.when(F.col("__up") == 1, "ancestor").otherwise("descendant").alias("direction"), "node")


def lineage(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(study_id, root, id, direction): each root with its directed ancestors and descendants."""
    own = roots.select("study_id", F.col("id").alias("root"), "id", F.lit("self").alias("direction")).distinct()
    return own.unionByName(_reach(edges, roots, ["descendant", "ancestor"]).withColumnRenamed("node", "id"))


def impact(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Outputs that depend on the given domains or data sets; only ancestors are walked."""
    up = _reach(edges, roots, ["ancestor"]).filter(F.col("node").startswith("tlf:"))
    return up.select("study_id", "root", F.col("node").alias("output")).distinct()


def build_issues(objectives: DataFrame, endpoints: DataFrame, tlfs: DataFrame, nodes: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """Blocked outputs, clarifications, absent domains with the number of outputs they block, coverage gaps and info lines."""
    def issue(df, severity, node, message):
        return df.select("study_id", F.lit(severity).alias("severity"), node.alias("node_id"), message.alias("message"))

    p = lambda prefix, c: F.concat(F.lit(prefix), F.col(c))
    name = F.coalesce("title", "candidate_id")
    blocked, asked = (tlfs.filter(F.col("status") == s) for s in ("blocked", "needs-clarification"))
    gone = nodes.filter((F.col("type") == "SDTM") & F.col("absent")).select("study_id", "id", F.col("label").alias("domain"))
    declared = tlfs.select("study_id", "candidate_id", F.explode("req_sdtm").alias("domain")).withColumn("domain", F.upper("domain")).distinct()
    n_blocked = declared.groupBy("study_id", "domain").agg(F.count(F.lit(1)).alias("n"))
    gone = keyed_join(gone, n_blocked, ["study_id", "domain"])
    used_end = tlfs.select("study_id", F.explode("endpoint_ids").alias("endpoint_id")).distinct()
    used_obj = tlfs.select("study_id", F.explode("objective_ids").alias("objective_id")).distinct()
    through = keyed_join(endpoints.select("study_id", "endpoint_id", "objective_id"), used_end, ["study_id", "endpoint_id"], "left_semi")
    reached = used_obj.unionByName(through.select("study_id", "objective_id")).distinct()
    lost_obj = keyed_join(objectives, reached, ["study_id", "objective_id"], "left_anti")
    lost_end = keyed_join(endpoints.filter("RESOLVED"), used_end, ["study_id", "endpoint_id"], "left_anti")
    say = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    parts = [
        issue(blocked, "blocked", p("tlf:", "candidate_id"), F.coalesce("status_reason", say("Cannot be produced: ", name))),
        issue(asked, "clarification", p("tlf:", "candidate_id"), F.coalesce("status_reason", say("Open question: ", name))),
        issue(endpoints.filter("NOT RESOLVED"), "clarification", p("end:", "endpoint_id"), say("No measure could be read from endpoint ", F.col("endpoint_id"))),
        issue(gone, "blocked", F.col("id"), say("No data for ", F.col("domain"), F.when(F.col("n") > 0, say(" (outputs asking for it: ", F.col("n").cast("string"), ")")).otherwise(""))),
        issue(lost_obj, "gap", p("obj:", "objective_id"), say("Nothing planned for objective ", F.col("objective_id"))),
        issue(lost_end, "gap", p("end:", "endpoint_id"), say("Nothing planned for endpoint ", F.col("endpoint_id"))),
    ]
    if info is not None:
        parts.append(issue(info, "info", F.lit(None).cast("string"), F.col("message")))
    return reduce(DataFrame.unionByName, parts)


def issue_relations(tlfs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(study_id, node_id, related), in long form: the outputs each absent domain blocks, and the absent domains each blocked output lacks."""
    gone = nodes.filter((F.col("type") == "SDTM") & F.col("absent")).select("study_id", "id", F.col("label").alias("domain"))
    declared = tlfs.select("study_id", "candidate_id", F.explode("req_sdtm").alias("domain")).withColumn("domain", F.upper("domain")).distinct()
    met = keyed_join(declared, gone, ["study_id", "domain"], "inner").select("study_id", "candidate_id", F.concat(F.lit("tlf:"), "candidate_id").alias("output"), "id")
    blocked = keyed_join(met, tlfs.filter(F.col("status") == "blocked").select("study_id", "candidate_id").distinct(), ["study_id", "candidate_id"], "left_semi")
    return met.select("study_id", F.col("id").alias("node_id"), F.col("output").alias("related")).unionByName(
        blocked.select("study_id", F.col("output").alias("node_id"), F.col("id").alias("related")))


def graph_counts(nodes: DataFrame) -> DataFrame:
    """Node tallies per study."""
    kind = lambda t: F.col("type") == t
    return nodes.groupBy("study_id").agg(
        F.count_if(kind("Objective")).alias("objectives"), F.count_if(kind("Endpoint")).alias("endpoints"),
        F.count_if(kind("Endpoint") & F.col("unresolved")).alias("endpoints_unresolved"), F.count_if(kind("SDTM")).alias("sdtm"),
        F.count_if(kind("SDTM") & F.col("absent")).alias("sdtm_absent"), F.count_if(kind("ADaM")).alias("adam"), F.count_if(kind("TLF")).alias("tlf"),
        *[F.count_if(kind("TLF") & (F.col("status") == s)).alias("tlf_" + s.replace("-", "_")) for s in ("planned", "blocked", "needs-clarification")])


def variable_edges(spec: DataFrame) -> DataFrame:
    """(study_id, source, target): each variable to the raw domains its role text names, by ``infer_domains``.

    ``spec`` has dataset, variable, role and sdtm_source.
    """
    from ..functions.scalars import infer_domains

    return spec.select("study_id", F.concat_ws(".", "dataset", "variable").alias("source"), F.explode(infer_domains("role", "sdtm_source")).alias("d")).select(
        "study_id", "source", F.concat(F.lit("sdtm:"), F.upper("d")).alias("target")).distinct()


def map_edges(docs: DataFrame, column: str = "doc") -> DataFrame:
    """Endpoint to output, and endpoint to the output that gives its population context, from the maps of a trace document."""
    schema = "struct<endpointOutputMap:map<string,array<string>>,populationContext:map<string,string>>"
    parsed = docs.select("study_id", F.from_json(column, schema).alias("m"))
    outputs = parsed.select("study_id", F.explode("m.endpointOutputMap").alias("k", "vs")).select(
        "study_id", F.concat(F.lit("end:"), "k").alias("source"), F.explode("vs").alias("v")).select(
        "study_id", "source", F.concat(F.lit("tlf:"), "v").alias("target"), F.lit("end-tlf").alias("kind"))
    context = parsed.select("study_id", F.explode("m.populationContext").alias("k", "v")).select(
        "study_id", F.concat(F.lit("end:"), "k").alias("source"), F.concat(F.lit("tlf:"), "v").alias("target"), F.lit("context").alias("kind"))
    return outputs.unionByName(context)
