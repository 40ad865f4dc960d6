"""Planning, numbering and audit of outputs as joins with rule tables, for many studies at once.

Candidates are flat rows: study_id, candidate_id, type, category, title,
objective_ids, endpoint_ids, regulatory_rule, method, population, timepoint,
imputation, subgroup, comparison, req_adam, req_sdtm, priority, produced_by, status,
status_reason, notes. Rule tables are short literals and are broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalars import normalise_title
from ..session import checkpointed
from . import catalogues as cat
from .groups import keyed_join
from .quality import findings

STUDY = ["study_id"]
TEXT_FIELDS = ["type", "category", "title", "regulatory_rule", "method", "population", "timepoint", "imputation", "subgroup",
               "comparison", "priority", "produced_by", "status", "status_reason"]
ARRAY_FIELDS = ["objective_ids", "endpoint_ids", "req_adam", "req_sdtm", "notes"]
CANDIDATE = ["study_id", "candidate_id", *TEXT_FIELDS, *ARRAY_FIELDS]


def _rule_table(spark, rows: Sequence[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))


def candidates(df: DataFrame) -> DataFrame:
    """Complete a frame to the candidate schema; absent fields become null or empty."""
    have = set(df.columns)
    text = [(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in TEXT_FIELDS]
    arrays = [F.coalesce(F.col(c) if c in have else F.lit(None), F.array()).cast("array<string>").alias(c) for c in ARRAY_FIELDS]
    return df.select("study_id", "candidate_id", *text, *arrays)


def _sources(column: str) -> Column:
    return F.filter(F.split(column, ","), lambda x: x != "")


# ---- study profile -------------------------------------------------------------------


def profile_studies(studies: DataFrame, endpoints: DataFrame, arms: DataFrame, overrides: DataFrame | None = None,
                    objectives: DataFrame | None = None, inventory: DataFrame | None = None, estimands: DataFrame | None = None,
                    regions: DataFrame | None = None) -> DataFrame:
    """Flags per study from keyword rules over endpoint, title and arm text.

    ``studies`` has phase and title, ``endpoints`` has text and domain_hint, ``arms``
    has name and type. Any text of a study may set a flag, objectives' text included
    where given, so one aggregate per table decides. An ``inventory`` of raw domains
    opens the gates of medical history (MH), deviations (DV) and deaths (DD). ``estimands`` (name, population_summary) and ``regions``
    (study_id, region of each site or subject) set the subgroup flags where the texts do not.
    """
    def any_match(column: str, words: str) -> Column:
        return F.coalesce(F.bool_or(F.col(column).rlike(words)), F.lit(False))

    ind = {f"ind_{i}": w for i, (w, _, _) in enumerate(cat.INDICATIONS)}
    words = {**cat.FLAG_KEYWORDS, **ind}
    blind = {"b_double": "(?i)double[- ]blind", "b_single": "(?i)single[- ]blind", "b_open": "(?i)open[- ]label"}
    text = endpoints.select("study_id", "text", "domain_hint").unionByName(
        arms.select("study_id", F.col("name").alias("text"), F.lit(None).cast("string").alias("domain_hint"))).unionByName(
        studies.select("study_id", F.col("title").alias("text"), F.lit(None).cast("string").alias("domain_hint")))
    if objectives is not None:
        text = text.unionByName(objectives.select("study_id", "text", F.lit(None).cast("string").alias("domain_hint")))
    if estimands is not None:
        text = text.unionByName(estimands.select("study_id", F.concat_ws(" ", "name", "population_summary").alias("text"), F.lit(None).cast("string").alias("domain_hint")))
    by_text = text.groupBy("study_id").agg(
        *[any_match("text", w).alias(n) for n, w in {**words, **blind}.items()],
        F.coalesce(F.bool_or(F.col("domain_hint") == "pk"), F.lit(False)).alias("pk_hint"),
        F.coalesce(F.bool_or(F.col("domain_hint") == "safety-ae"), F.lit(False)).alias("ae_hint"))
    dose_level = F.col("name").rlike(r"(?i)^cohort \d|^\d+ ?mg$")
    by_arm = arms.groupBy("study_id").agg(
        F.count(F.lit(1)).alias("arm_count"), F.coalesce(F.bool_or(F.col("type").rlike("(?i)placebo")), F.lit(False)).alias("placebo"),
        F.coalesce(F.bool_and(dose_level), F.lit(False)).alias("only_doses"))
    p = studies.select("study_id", "phase").join(by_text, "study_id", "left").join(by_arm, "study_id", "left")
    confirmatory = F.coalesce(F.col("phase").rlike(r"(?i)phase (ii|iii|2|3)\b"), F.lit(False))
    arm_count = F.coalesce("arm_count", F.lit(0))
    pick = lambda i: F.coalesce(*[F.when(F.col(f"ind_{k}"), F.lit(r[i])) for k, r in enumerate(cat.INDICATIONS)])
    area = F.coalesce(pick(2), F.lit("other"))
    out = p.select(
        "study_id", "phase", arm_count.alias("arm_count"),
        F.when(F.col("placebo"), "placebo").when(arm_count >= 2, "active").when(arm_count == 1, "none").otherwise("unknown").alias("control_type"),
        F.when(arm_count == 1, "single-arm").when(F.col("crossover_words"), "crossover").when(F.col("only_doses"), "dose-finding")
        .when(arm_count >= 2, "parallel").otherwise("unknown").alias("design"),
        F.when(F.col("b_double"), "double-blind").when(F.col("b_single"), "single-blind").when(F.col("b_open"), "open-label")
        .when(F.col("placebo") & confirmatory, "double-blind").when(F.col("placebo"), "single-blind").otherwise("unknown").alias("blinding"),
        pick(1).alias("indication"), area.alias("therapeutic_area"), confirmatory.alias("multi_site"),
        (F.col("needs_pk") | F.col("pk_hint")).alias("needs_pk"), "needs_pd", "needs_immunogenicity",
        (F.col("onc_words") & (area == "Oncology")).alias("needs_oncology_response"), "needs_pro_hrqol", "needs_tte_safety_figure", "has_ecg",
        (F.coalesce(F.col("phase").rlike(r"(?i)phase (iii|3)\b"), F.lit(False)) | F.coalesce("sex_words", F.lit(False))).alias("needs_subgroup_by_sex"),
        F.coalesce("region_words", F.lit(False)).alias("needs_subgroup_by_region"),
        *[F.coalesce(f, F.lit(False)).alias(f) for f in ("reports_ae_discontinuation", "reports_deaths", "reports_ae_severity")],
        (~F.coalesce("ae_hint", F.lit(False))).alias("not_covered_by_safety"),
        *[F.lit(False).alias(f) for f in ("medical_history_available", "deviations_tracked")])
    if inventory is not None:
        have = lambda d: F.bool_or(F.upper("domain") == d)
        found = inventory.groupBy("study_id").agg(have("MH").alias("__mh"), have("DV").alias("__dv"), have("DD").alias("__dd"))
        out = out.join(found, "study_id", "left").withColumns({
            "medical_history_available": F.coalesce("__mh", F.lit(False)), "deviations_tracked": F.coalesce("__dv", F.lit(False)),
            "reports_deaths": F.col("reports_deaths") | F.coalesce("__dd", F.lit(False))}).drop("__mh", "__dv", "__dd")
    if regions is not None:
        several = regions.groupBy("study_id").agg((F.min("region") != F.max("region")).alias("__several"))
        out = keyed_join(out, several, STUDY).withColumn(
            "needs_subgroup_by_region", F.col("needs_subgroup_by_region") | F.coalesce("__several", F.lit(False))).drop("__several")
    if overrides is None:
        return out
    given = [c for c in overrides.columns if c != "study_id"]
    renamed = overrides.select("study_id", *[F.col(c).alias(f"__{c}") for c in given])
    return out.join(renamed, "study_id", "left").withColumns(
        {c: F.coalesce(F.col(f"__{c}"), F.col(c)) if c in out.columns else F.col(f"__{c}") for c in given}).drop(*[f"__{c}" for c in given])


def _flags(profiles: DataFrame, names: Sequence[str]) -> DataFrame:
    """(study_id, flags): the flags that are set, as a map of few entries."""
    names = sorted({n for n in names if n and n in profiles.columns})
    return profiles.select("study_id", F.array_compact(F.array(F.lit(""), *[F.when(F.col(n), F.lit(n)) for n in names])).alias("__set"))


def _gated(profiles: DataFrame, rules: DataFrame, gates: Sequence[str]) -> DataFrame:
    """Each study with the rule rows whose gate is open for it."""
    return _flags(profiles, gates).crossJoin(rules).filter(F.array_contains("__set", F.col("gate"))).drop("__set")


# ---- candidates ------------------------------------------------------------------------


def scaffolding(profiles: DataFrame) -> DataFrame:
    """Core and gated outputs that every report needs whatever its objectives."""
    spark = profiles.sparkSession
    rules = _rule_table(spark, cat.SCAFFOLDING, "candidate_id string, title string, type string, category string, regulatory_rule string, gate string, population string")
    rows = _gated(profiles, rules, [r[5] for r in cat.SCAFFOLDING])
    return candidates(_with_sources(rows).withColumns({
        "method": F.lit("Descriptive"), "imputation": F.lit("none"), "priority": F.lit("supportive"), "produced_by": F.lit("scaffolding"), "status": F.lit("planned")}))


def _with_sources(df: DataFrame, fill_only: bool = False) -> DataFrame:
    """Raw and analysis sources by category."""
    rules = _rule_table(df.sparkSession, [(c, s, a) for c, s, a, _ in cat.CATEGORIES], "category string, __s string, __a string")
    out = df.join(rules, "category", "left")
    return out.withColumns({"req_sdtm": _sources("__s"), "req_adam": _sources("__a")}).drop("__s", "__a")


def efficacy(endpoints: DataFrame, estimands: DataFrame | None = None) -> DataFrame:
    """Method stack per resolved efficacy endpoint by measure type and level, per stated timepoint where the rule says so.

    ``endpoints`` has objective_id, endpoint_id, level and the parsed columns. A
    windowed endpoint ("from ... to ...") gives one output over its range. The
    intercurrent-event strategy of the endpoint's estimand sets the imputation,
    treatment policy where none is stated.
    """
    spark = endpoints.sparkSession
    rules = _rule_table(spark, cat.EFFICACY, "MEASURE_TYPE string, level string, role string, method string, type string, per_time boolean, imp string, priority string")
    strategies = _rule_table(spark, list(cat.STRATEGY_IMPUTATION.items()), "strategy string, by_strategy string")
    base = endpoints.filter(F.col("RESOLVED") & (F.col("DOMAIN_HINT").startswith("efficacy") | (
        (F.col("DOMAIN_HINT") == "other") & F.col("MEASURE_TYPE").isNotNull())))
    joined = base.join(rules, ["MEASURE_TYPE", "level"])
    if estimands is not None:
        one = estimands.groupBy("study_id", "endpoint_id").agg(F.min("strategy").alias("strategy"))
        joined = keyed_join(joined, one, ["study_id", "endpoint_id"])
    else:
        joined = joined.withColumn("strategy", F.lit(None).cast("string"))
    joined = joined.withColumn("strategy", F.coalesce("strategy", F.lit("Treatment Policy"))).join(strategies, "strategy", "left")
    # outer explode: a plain one would push a copy of the whole parsing below the joins as a filter
    points = F.col("TIMEPOINTS")
    whole = F.when(F.size(points) > 0, F.when(F.col("WINDOWED"), F.array_join(points, " to ")).otherwise(F.array_join(points, " & ")))
    times = F.when(F.col("per_time") & ~F.col("WINDOWED") & (F.size(points) > 1), points).otherwise(F.array(whole))
    rows = joined.withColumn("__times", times).withColumn("timepoint", F.explode_outer("__times")).withColumns({
        "candidate_id": F.lower(F.concat_ws("-", F.lit("eff"), "endpoint_id", "role",
                                            F.when(F.col("per_time") & ~F.col("WINDOWED") & (F.size(points) > 1), F.regexp_replace("timepoint", " ", "")))),
        "title": F.concat_ws(" - ", F.col("MEASURE"), F.col("method"), F.col("timepoint")),
        "category": F.lit("efficacy"), "objective_ids": F.array("objective_id"), "endpoint_ids": F.array("endpoint_id"),
        "population": F.lit("Efficacy"), "produced_by": F.lit("efficacy"), "status": F.lit("planned"),
        "imputation": F.when(F.col("imp") == "strategy", F.coalesce("by_strategy", F.lit("none"))).otherwise(F.lit("none")),
    })
    return candidates(_with_sources(rows))


def safety(endpoints: DataFrame, profiles: DataFrame) -> DataFrame:
    """Family members per resolved safety endpoint, by domain hint and gate; ECG members where an ECG is named."""
    spark = endpoints.sparkSession
    rules = _rule_table(spark, cat.SAFETY, "DOMAIN_HINT string, slug string, title string, type string, method string, category string, gate string, comparison string")
    base = endpoints.filter(F.col("RESOLVED")).select("study_id", "objective_id", "endpoint_id", "DOMAIN_HINT", "text")
    ecg = base.filter(F.col("text").rlike(cat.FLAG_KEYWORDS["has_ecg"])).withColumn("DOMAIN_HINT", F.lit("safety-ecg"))
    hits = base.unionByName(ecg).join(rules, "DOMAIN_HINT")
    gated = keyed_join(hits, _flags(profiles, [r[6] for r in cat.SAFETY]), STUDY, "inner").filter(F.array_contains("__set", F.col("gate")))
    short = F.regexp_replace("DOMAIN_HINT", "^safety-", "")
    rows = gated.withColumns({
        "candidate_id": F.lower(F.concat_ws("-", short, "endpoint_id", "slug")), "objective_ids": F.array("objective_id"), "endpoint_ids": F.array("endpoint_id"),
        "population": F.lit("Safety"), "imputation": F.lit("none"), "priority": F.lit("secondary"), "produced_by": F.lit("safety"),
        "status": F.lit("planned"), "comparison": F.when(F.col("comparison") != "", F.col("comparison"))})
    return candidates(_with_sources(rows))


def special(profiles: DataFrame) -> DataFrame:
    """Outputs of the special domains whose flag is set."""
    rules = _rule_table(profiles.sparkSession, cat.SPECIAL, "candidate_id string, title string, type string, method string, category string, gate string, __a string, __s string")
    rows = _gated(profiles, rules, [r[5] for r in cat.SPECIAL]).withColumns({
        "req_adam": _sources("__a"), "req_sdtm": _sources("__s"), "priority": F.lit("supportive"), "imputation": F.lit("none"),
        "produced_by": F.lit("special domains"), "status": F.lit("planned")})
    return candidates(rows)


def expand_variants(cands: DataFrame, profiles: DataFrame, regions: Sequence[str] | DataFrame = ()) -> DataFrame:
    """Seeds fanned out by imputation, subgroup and timepoint; every other candidate passes through.

    Primary continuous analyses (ANCOVA) give a LOCF and an observed-cases variant,
    and by flag the two sexes and the given regions on LOCF. Candidates that list
    several timepoints give one each. ``regions`` is a list for every study or a table (study_id, region). Ids get the changed tokens in fixed order.
    """
    flagged = keyed_join(cands, _flags(profiles, ["needs_subgroup_by_sex", "needs_subgroup_by_region"]), STUDY)
    has = lambda f: F.coalesce(F.array_contains("__set", F.lit(f)), F.lit(False))
    seed = (F.col("produced_by") == "efficacy") & (F.col("priority") == "primary") & (F.col("method") == "ANCOVA")

    def variant(token, imputation, subgroup, population, priority, suffix, on=None):
        lit = lambda x: F.lit(x).cast("string")
        v = F.struct(lit(token).alias("token"), lit(imputation).alias("imp"), lit(subgroup).alias("sub"),
                     lit(population).alias("pop"), lit(priority).alias("pri"), lit(suffix).alias("suffix"))
        return v if on is None else F.when(on, v)

    plain = variant(None, None, None, None, None, None)
    fan = [variant("locf", "LOCF", None, None, None, "LOCF"),
           variant("oc", "OC", None, "Completers", "supportive", "Completers, Observed Cases, Windowed")]
    for s in ("Male", "Female"):
        fan.append(variant(f"locf-{s.lower()}", "LOCF", f"Sex={s}", None, "supportive", f"{s} subjects", has("needs_subgroup_by_sex")))
    table = regions if isinstance(regions, DataFrame) else None
    for r in () if table is not None else regions:
        fan.append(variant(f"locf-{r.lower()}", "LOCF", f"Region={r}", None, "supportive", f"{r} subjects", has("needs_subgroup_by_region")))
    rows = flagged.withColumn("__v", F.explode_outer(F.when(seed, F.array_compact(F.array(*fan))).otherwise(F.array(plain))))
    if table is not None:
        name = F.col("__region")
        own = F.struct(F.concat(F.lit("locf-"), F.lower(name)).alias("token"), F.lit("LOCF").alias("imp"), F.concat(F.lit("Region="), name).alias("sub"),
                       F.lit(None).cast("string").alias("pop"), F.lit("supportive").alias("pri"), F.concat(name, F.lit(" subjects")).alias("suffix"))
        named = table.filter(F.col("region").isNotNull()).select("study_id", F.col("region").alias("__region")).distinct()
        rows = rows.unionByName(keyed_join(flagged.filter(seed & has("needs_subgroup_by_region")), named, STUDY, "inner").withColumn("__v", own).drop("__region"))
    rows = rows.withColumn("__times", F.when(F.col("timepoint").contains(" & "), F.split("timepoint", " & ")).otherwise(F.array("timepoint")))
    rows = rows.withColumn("__split", F.size("__times") > 1).withColumn("__t", F.explode_outer("__times"))
    note = F.when(F.col("__v.token").isNotNull() | F.col("__split"), F.array(F.lit("variant assumed")))
    return rows.withColumns({
        "candidate_id": F.concat_ws("-", "candidate_id", "__v.token", F.when(F.col("__split"), F.lower(F.regexp_replace("__t", " ", "")))),
        "title": F.concat_ws(" - ", "title", "__v.suffix", F.when(F.col("__split"), F.col("__t"))),
        "timepoint": F.col("__t"), "imputation": F.coalesce("__v.imp", "imputation"), "subgroup": F.coalesce("__v.sub", "subgroup"),
        "population": F.coalesce("__v.pop", "population"), "priority": F.coalesce("__v.pri", "priority"),
        "notes": F.concat("notes", F.coalesce(note, F.array().cast("array<string>"))),
    }).select(*CANDIDATE)


def feasibility(cands: DataFrame, unresolved: DataFrame, inventory: DataFrame) -> DataFrame:
    """Status and reason, first rule that applies: unresolved endpoint, unmapped measure, missing raw domain, planned.

    ``unresolved`` has (study_id, endpoint_id), ``inventory`` (study_id, domain).
    Needs are compared as exploded rows, so neither list of a study is gathered;
    analysis data sets never block.
    """
    key = ["study_id", "candidate_id"]
    mapped = F.array_contains(F.array(*[F.lit(c[0]) for c in cat.CATEGORIES]), F.col("category")) | (F.size("req_sdtm") > 0) | (F.size("req_adam") > 0)
    uses = cands.select(*key, F.explode("endpoint_ids").alias("endpoint_id"))
    open_ = keyed_join(uses, unresolved.select("study_id", "endpoint_id").distinct(), ["study_id", "endpoint_id"], "left_semi")
    first_open = open_.groupBy(*key).agg(F.min("endpoint_id").alias("__open"))
    needs = cands.select(*key, F.explode("req_sdtm").alias("domain")).withColumn("domain", F.upper("domain"))
    gone = keyed_join(needs, inventory.select("study_id", F.upper("domain").alias("domain")).distinct(), ["study_id", "domain"], "left_anti")
    missing = gone.groupBy(*key).agg(F.array_join(F.sort_array(F.collect_set("domain")), ", ").alias("__gone"))
    out = keyed_join(keyed_join(cands, first_open, key), missing, key)
    return out.withColumns({
        "status": F.when(F.col("__open").isNotNull(), "needs-clarification").when(~mapped, "needs-clarification")
        .when(F.col("__gone").isNotNull(), "blocked").otherwise("planned"),
        "status_reason": F.when(F.col("__open").isNotNull(), F.concat(F.lit("Traces to unresolved endpoint "), "__open"))
        .when(~mapped, F.concat(F.lit("No source domain is known for "), F.col("category")))
        .when(F.col("__gone").isNotNull(), F.concat(F.lit("Missing raw domain "), "__gone")),
    }).drop("__open", "__gone")


# ---- consolidation -------------------------------------------------------------------------


def section_of(category: Column | str = "category") -> Column:
    c = F.col(category) if isinstance(category, str) else category
    return F.coalesce(*[F.when(c == name, F.lit(sec)) for name, _, _, sec in cat.CATEGORIES], F.lit("14-x"))


_SPECIALISTS = ("efficacy", "safety", "special domains")


def dedup_candidates(cands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Survivors and the log of merged losers.

    Duplicates share section, title core and analysis. The survivor has the most
    complete sources, then the more specific analysis, the fuller provenance, a
    specialist planner, the least id; it is found by ``min_by``. Ids and sources of
    losers are unioned over distinct values, whose number is bounded by the study
    model. The log is a table, one row per loser, so a large group of copies is
    never held in one list.
    """
    specific = F.col("method").isNotNull() & ~F.col("method").isin("Descriptive", "none")
    rank = F.struct(
        -(F.size("req_adam") + F.size("req_sdtm")), F.when(specific, 0).otherwise(1),
        -(F.when(F.size("endpoint_ids") > 0, 2).otherwise(0) + F.when(F.size("objective_ids") > 0, 1).otherwise(0)),
        F.when(F.col("produced_by").isin(*_SPECIALISTS), 0).otherwise(1), F.col("candidate_id"))
    parts = ["study_id", "__section", "__core", "method", "population", "timepoint", "imputation", "subgroup"]
    keyed = cands.withColumns({"__section": section_of(), "__core": normalise_title("title", "study_id")}).withColumn(
        "__key", F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256))
    key = ["study_id", "__key"]
    best = keyed.groupBy(*key).agg(
        F.min_by("candidate_id", rank).alias("survivor_id"), F.count(F.lit(1)).alias("n_merged"), F.max("regulatory_rule").alias("__rule"))
    marked = checkpointed(keyed_join(keyed, best, key))  # survivors, merges and unions read it
    merges = marked.filter(F.col("candidate_id") != F.col("survivor_id")).select(
        "study_id", "survivor_id", F.col("candidate_id").alias("merged_id"), F.col("produced_by").alias("merged_from"))
    survivors = marked.filter(F.col("candidate_id") == F.col("survivor_id"))
    fields = ("objective_ids", "endpoint_ids", "req_adam", "req_sdtm")

    def tagged(field: str) -> Column:
        return F.transform(field, lambda x: F.struct(F.lit(field).alias("f"), x.alias("x")))

    pairs = F.flatten(F.array(*[tagged(f) for f in fields]))
    # only groups with losers need a union
    shared = marked.filter("n_merged > 1").select(*key, F.inline(pairs)).distinct().groupBy(*key).agg(
        *[F.sort_array(F.collect_list(F.when(F.col("f") == f, F.col("x")))).alias(f"__{f}") for f in fields])
    survivors = keyed_join(survivors, shared, key).withColumns({f: F.coalesce(f"__{f}", f) for f in fields})
    survivors = survivors.withColumn("regulatory_rule", F.coalesce("regulatory_rule", "__rule"))
    return survivors.select(*CANDIDATE, "n_merged"), merges


def merged_notes(cands: DataFrame, merges: DataFrame) -> DataFrame:
    """Notes of survivors and of what was merged into them, one row per distinct note (study_id, candidate_id, note)."""
    into = merges.select("study_id", F.col("merged_id").alias("candidate_id"), "survivor_id")
    notes = cands.select("study_id", "candidate_id", F.explode("notes").alias("note"))
    return keyed_join(notes, into, ["study_id", "candidate_id"]).select(
        "study_id", F.coalesce("survivor_id", "candidate_id").alias("candidate_id"), "note").distinct()


def row_numbers(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``row_number`` per group in a total order, whatever the size of a group.

    Rows are sorted over the whole cluster, materialised once with their position,
    and numbered by the offset of their sorted partition.
    """
    placed = checkpointed(df.orderBy(*by, *order).withColumn("__pos", F.monotonically_increasing_id()))
    placed = placed.withColumns({"__part": F.shiftright("__pos", 33), "__in": F.col("__pos").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    run = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)  # one row per sorted partition
    offsets = sizes.withColumn("__off", F.coalesce(F.sum("__n").over(run), F.lit(0))).drop("__n")
    positioned = placed.join(offsets, "__part").withColumn("__at", F.col("__off") + F.col("__in"))
    starts = positioned.groupBy(*by).agg(F.min("__at").alias("__start"))
    return keyed_join(positioned, starts, by).withColumn(name, (F.col("__at") - F.col("__start") + 1).cast("int")).drop(
        "__pos", "__part", "__in", "__off", "__at", "__start")


# Order of priorities.
PRIORITY_ORDER = {"primary": 1, "secondary": 2, "supportive": 3}


def variant_rank() -> Column:
    """Primary analysis, sensitivity, subgroups, descriptive, model-based, categorical."""
    m, s = F.col("method"), F.coalesce(F.col("subgroup"), F.lit(""))
    return (F.when(F.col("imputation") == "OC", 2).when(s == "Sex=Male", 3).when(s == "Sex=Female", 4).when(s != "", 5)
            .when(m == "Descriptive", 6).when(m == "MMRM", 7).when(m.isin("CMH", "Fisher"), 8).otherwise(1))


def week_rank(column: str = "timepoint") -> Column:
    """Baseline, then by first week named, others last."""
    week = F.regexp_extract(F.col(column), r"(?i)(?:week|day) (\d+)", 1).try_cast("int")
    return F.when(F.col(column).startswith("Baseline"), 0).otherwise(F.coalesce(week, F.lit(99999)))


def number_outputs(cands: DataFrame) -> DataFrame:
    """final_id on planned outputs: tables and listings per section and type, figures per study."""
    prefix = F.when(F.col("type") == "Figure", "F").when(F.col("type") == "Listing", "L").otherwise("T")
    df = cands.withColumns({"section": section_of(), "__p": prefix})
    planned = df.filter(F.col("status") == "planned").withColumn("__sec", F.when(F.col("__p") == "F", "").otherwise(F.col("section")))
    priority = F.coalesce(*[F.when(F.col("priority") == k, F.lit(i)) for k, i in PRIORITY_ORDER.items()], F.lit(9))
    order = [F.col("section"), priority, week_rank(), variant_rank(), F.col("candidate_id")]
    numbered = row_numbers(planned, ["study_id", "__p", "__sec"], order, "seq")
    seq = F.when(F.col("seq") < 10, F.concat(F.lit("0"), F.col("seq").cast("string"))).otherwise(F.col("seq").cast("string"))
    final = F.when(F.col("__p") == "F", F.concat(F.lit("F-14-"), F.col("seq").cast("string"))).otherwise(
        F.concat(F.col("__p"), F.lit("-"), F.col("section"), F.lit("."), seq))
    rest = df.filter(~F.col("status").eqNullSafe(F.lit("planned"))).withColumn("final_id", F.lit(None).cast("string"))
    return numbered.withColumn("final_id", final).drop("seq", "__sec").unionByName(rest).drop("__p")


# ---- audit ---------------------------------------------------------------------------------------


def coverage(endpoints: DataFrame, cands: DataFrame) -> DataFrame:
    """Per endpoint: covered, gap, gap (blocked) or clarification."""
    uses = cands.select("study_id", F.explode("endpoint_ids").alias("endpoint_id"), "status")
    facts = uses.groupBy("study_id", "endpoint_id").agg(
        F.count_if(F.col("status") == "planned").alias("n_planned"), F.count(F.lit(1)).alias("n_any"))
    out = keyed_join(endpoints.select("study_id", "objective_id", "endpoint_id", "RESOLVED", "DOMAIN_HINT"), facts, ["study_id", "endpoint_id"])
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.withColumns({"n_planned": n("n_planned"), "n_any": n("n_any")}).withColumn(
        "coverage", F.when(~F.col("RESOLVED"), "clarification").when(F.col("n_planned") > 0, "covered")
        .when(F.col("n_any") > 0, "gap (blocked)").otherwise("gap"))


def objective_coverage(objectives: DataFrame, covered: DataFrame, cands: DataFrame) -> DataFrame:
    """Per objective: covered, clarification (only unresolved endpoints) or gap."""
    by_end = covered.groupBy("study_id", "objective_id").agg(
        F.bool_or(F.col("coverage") == "covered").alias("__c"), F.bool_and(F.col("coverage") == "clarification").alias("__q"))
    direct = cands.filter(F.col("status") == "planned").select("study_id", F.explode("objective_ids").alias("objective_id")).distinct().withColumn("__d", F.lit(True))
    key = ["study_id", "objective_id"]
    out = keyed_join(keyed_join(objectives.select(*key), by_end, key), direct, key)
    return out.select(*key, F.when(F.coalesce("__c", F.lit(False)) | F.coalesce("__d", F.lit(False)), "covered")
                      .when(F.coalesce("__q", F.lit(False)), "clarification").otherwise("gap").alias("coverage"))


def orphans(cands: DataFrame, objectives: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Per candidate: provenance class and the number of dangling or unresolved ids it cites."""
    key = ["study_id", "candidate_id"]
    obj = keyed_join(cands.select(*key, F.explode("objective_ids").alias("objective_id")), objectives.select("study_id", "objective_id"),
                     ["study_id", "objective_id"], "left_anti")
    end = keyed_join(cands.select(*key, F.explode("endpoint_ids").alias("endpoint_id")),
                     endpoints.filter("RESOLVED").select("study_id", "endpoint_id"), ["study_id", "endpoint_id"], "left_anti")
    bad = obj.select(*key).unionByName(end.select(*key)).groupBy(*key).agg(F.count(F.lit(1)).alias("bad_ids"))
    out = keyed_join(cands.select(*key, "objective_ids", "endpoint_ids", "regulatory_rule"), bad, key)
    return out.select(*key, F.when(F.size("objective_ids") > 0, "objective-driven").when(F.size("endpoint_ids") > 0, "endpoint-driven")
                      .when(F.col("regulatory_rule").isNotNull(), "scaffolding").otherwise("orphan").alias("provenance"),
                      F.coalesce("bad_ids", F.lit(0)).alias("bad_ids"))


def completeness(objectives: DataFrame, endpoints: DataFrame, cands: DataFrame, profiles: DataFrame) -> DataFrame:
    """The ten convention checks per study; one row per check that fires, with its recommendation and owner.

    A study speaks of safety through its endpoints or through the text of an objective.
    """
    p = cands.filter(F.col("status") == "planned")
    any_ = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    t = F.lower("title")
    plan = p.groupBy("study_id").agg(
        any_(t.rlike("death|mortality")).alias("deaths"), any_(t.rlike("discontinuation")).alias("disc"),
        any_(F.col("imputation") == "OC").alias("oc"), any_(F.col("method") == "MMRM").alias("mmrm"), any_(F.col("method") == "ANCOVA").alias("ancova"),
        any_(F.col("subgroup").isNotNull()).alias("subgroup"), any_(t.rlike("by site")).alias("site"),
        any_((F.col("category") == "safety-lab") & (F.col("method") == "ShiftTable")).alias("shift"),
        any_(F.col("category") == "disposition").alias("dispo"), any_(F.col("category") == "demographics").alias("demo"),
        any_((F.col("type") == "Figure") & (F.col("method") == "KaplanMeier")).alias("km"), any_(F.col("category") == "exposure").alias("expo"))
    model = endpoints.groupBy("study_id").agg(
        any_(F.col("DOMAIN_HINT").startswith("safety")).alias("safety"), any_(F.col("DOMAIN_HINT") == "safety-lab").alias("lab"),
        any_((F.col("level") == "Primary") & (F.col("MEASURE_TYPE") == "continuous") & F.col("DOMAIN_HINT").startswith("efficacy")).alias("primary_cont"),
        any_((F.col("level") == "Primary") & F.col("RESOLVED")).alias("primary"))
    aims = objectives.groupBy("study_id").agg(any_(F.col("text").rlike("(?i)safety|tolerab|adverse event")).alias("safety_aim"))
    df = profiles.select("study_id", "multi_site", "needs_tte_safety_figure").join(model, "study_id", "left").join(plan, "study_id", "left").join(aims, "study_id", "left")
    df = df.fillna(False, [c for c, tp in df.dtypes if tp == "boolean"])
    df = df.withColumn("safety", F.col("safety") | F.col("safety_aim"))
    c = F.col
    fires = {
        "C1": c("safety") & ~c("deaths"), "C2": c("safety") & ~c("disc"), "C3": c("primary_cont") & c("ancova") & ~c("oc"),
        "C4": c("primary_cont") & ~c("mmrm"), "C5": c("primary") & ~c("subgroup"), "C6": c("multi_site") & ~c("site"),
        "C7": c("lab") & ~c("shift"), "C8": ~c("dispo") | ~c("demo"), "C9": c("needs_tte_safety_figure") & ~c("km"), "C10": c("safety") & ~c("expo"),
    }
    rows = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(k).alias("check_id"), F.lit(cat.COMPLETENESS[k][0]).alias("recommendation"),
                                                           F.lit(cat.COMPLETENESS[k][1]).alias("phase"))) for k, cond in fires.items()]))
    return df.select("study_id", F.inline(rows))


def route_gaps(covered: DataFrame) -> DataFrame:
    """The phase each uncovered endpoint goes back to; blocked ones are a data matter."""
    gaps = covered.filter(F.col("coverage").startswith("gap"))
    hint = F.col("DOMAIN_HINT")
    phase = F.coalesce(*[F.when(hint.startswith(p), F.lit(r)) for p, r in cat.ROUTES], F.lit("special domains"))
    return gaps.select("study_id", "endpoint_id", "coverage", F.when(F.col("coverage") == "gap (blocked)", "feasibility").otherwise(phase).alias("phase"))


def verdict(covered: DataFrame, provenance: DataFrame) -> DataFrame:
    """clean, clean-with-caveats or gaps-found per study, with the counts behind it."""
    a = covered.groupBy("study_id").agg(
        F.count_if(F.col("coverage") == "covered").alias("covered"), F.count_if(F.col("coverage") == "gap").alias("gaps"),
        F.count_if(F.col("coverage") == "gap (blocked)").alias("soft_gaps"), F.count_if(F.col("coverage") == "clarification").alias("clarifications"))
    b = provenance.groupBy("study_id").agg(F.count_if(F.col("provenance") == "orphan").alias("orphans"), F.sum("bad_ids").alias("bad_ids"))
    df = a.join(b, "study_id", "full_outer").fillna(0)
    return df.withColumn("verdict", F.when((F.col("gaps") > 0) | (F.col("orphans") > 0), "gaps-found").when(
        (F.col("clarifications") > 0) | (F.col("soft_gaps") > 0) | (F.col("bad_ids") > 0), "clean-with-caveats").otherwise("clean"))


def reconcile(numbered: DataFrame) -> DataFrame:
    """Planned tables, figures and listings and flagged outputs per study and section."""
    ok = F.col("status") == "planned"
    kind = lambda t: F.count_if(ok & (F.col("type") == t))
    return numbered.groupBy("study_id", "section").agg(
        kind("Table").alias("tables"), kind("Figure").alias("figures"), kind("Listing").alias("listings"),
        F.count_if(ok).alias("planned"), F.count_if(~ok).alias("flagged"))


def assemble_specs(numbered: DataFrame) -> DataFrame:
    """One analysis recipe per planned output: set and record conditions and the method."""
    spark = numbered.sparkSession
    pops = _rule_table(spark, list(cat.POPULATIONS.items()), "population string, set_condition string")
    imps = _rule_table(spark, list(cat.IMPUTATION_FLAGS.items()), "imputation string, record_condition string")
    df = numbered.filter(F.col("status") == "planned").join(pops, "population", "left").join(imps, "imputation", "left")
    return df.select(
        "study_id", "candidate_id", F.regexp_replace("final_id", "^[TLF]-", "").alias("table_id"), "set_condition",
        F.concat_ws(" AND ", F.when(F.col("category") == "efficacy", F.col("record_condition")),
                    F.when(F.col("timepoint").rlike(r"^Week \d+$"), F.concat(F.lit("AVISIT = '"), "timepoint", F.lit("'")))).alias("record_condition"),
        F.col("method"))


def arm_levels(arms: DataFrame) -> DataFrame:
    """Treatment levels of each study in order, the first being the reference; shared by all its recipes."""
    return arms.select("study_id", F.col("position").alias("level_order"), F.col("name").alias("level"), (F.col("position") == 0).alias("is_reference"))


def aggregate_needs(cands: DataFrame) -> DataFrame:
    """What each analysis data set must serve: distinct (dataset, kind, value) over outputs, in long form."""
    uses = cands.filter(F.col("status") == "planned").select("study_id", F.explode("req_adam").alias("dataset"), "candidate_id", "method", "population")
    pairs = F.array(F.struct(F.lit("output").alias("kind"), F.col("candidate_id").alias("value")),
                    F.struct(F.lit("method").alias("kind"), F.col("method").alias("value")),
                    F.struct(F.lit("population").alias("kind"), F.col("population").alias("value")))
    return uses.select("study_id", "dataset", F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()
