"""Derived flags, rows and parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import bmi, bsa, derive_dt, study_day
from .groups import attach_aggregates, extreme_rows, keyed_join, order_key
from .merge import flag_exists, flag_overlap, merge_vars

SUBJECT = ("USUBJID",)


def _lit_row(values: Mapping) -> dict[str, Column]:
    return {k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()}


def flag_teae(df: DataFrame, cutoff_days: int | None = None, missing_start: str = "end_date") -> DataFrame:
    """TRTEMFL: started on or after first dose.

    A missing start counts when the end is on or after first dose ("end_date") or
    always ("always"). ``cutoff_days`` leaves out starts later than that after last dose.
    """
    start, end, first, last = F.col("ASTDT"), F.col("AENDT"), F.col("TRTSDT"), F.col("TRTEDT")
    no_start = start.isNull() & ((end >= first) if missing_start == "end_date" else F.lit(True))
    emergent = ((start >= first) | no_start) & first.isNotNull()
    if cutoff_days is not None:
        emergent = emergent & (start.isNull() | last.isNull() | (F.datediff(start, last) <= cutoff_days))
    return df.withColumn("TRTEMFL", F.when(emergent, F.lit("Y")))


def derive_populations(adsl: DataFrame, obs: DataFrame, endpoint_param: str, arm: str = "ARM",
                       completed: str | Column | None = None) -> DataFrame:
    """SAFFL, ITTFL, EFFFL (dosed, with baseline and post-baseline value) and, if asked for, COMPLFL.

    One aggregate over the records gives both existence facts.
    """
    records = keyed_join(obs.filter((F.col("PARAMCD") == endpoint_param) & F.col("AVAL").isNotNull()).select(
        "USUBJID", "ADT"), adsl.select("USUBJID", "TRTSDT"), SUBJECT, "inner")
    facts = records.groupBy("USUBJID").agg(
        F.bool_or(F.col("ADT") <= F.col("TRTSDT")).alias("__base"),
        F.bool_or(F.col("ADT") > F.col("TRTSDT")).alias("__post"),
    )
    yn = lambda c: F.when(F.coalesce(c, F.lit(False)), F.lit("Y")).otherwise(F.lit("N"))
    dosed = F.col("TRTSDT").isNotNull()
    out = keyed_join(adsl, facts, SUBJECT).withColumns({
        "SAFFL": yn(dosed),
        "ITTFL": yn(F.col(arm).isNotNull()),
        "EFFFL": yn(dosed & F.col(arm).isNotNull() & F.col("__base") & F.col("__post")),
    })
    if completed is not None:
        out = out.withColumn("COMPLFL", yn(F.expr(completed) if isinstance(completed, str) else completed))
    return out.drop("__base", "__post")


def pool_sites(adsl: DataFrame, arms: Sequence, threshold: int = 3, pooled: str = "900", site: str = "SITEID",
               arm: str = "TRT01PN", randomised: str = "ITTFL") -> DataFrame:
    """SITEGR1: a site keeps its id when every planned arm has at least ``threshold`` randomised subjects.

    Arms come from the caller's list, so an arm absent at a site counts as zero.
    """
    is_rand = F.col(randomised) == "Y"
    counts = adsl.groupBy(site).agg(
        F.least(*[F.count_if(is_rand & (F.col(arm) == F.lit(a))) for a in arms]).alias("__min")
        if len(arms) > 1 else F.count_if(is_rand & (F.col(arm) == F.lit(arms[0]))).alias("__min")
    )
    return keyed_join(adsl, counts, [site]).withColumn(
        "SITEGR1", F.when(F.col("__min") >= threshold, F.col(site)).otherwise(F.lit(pooled))
    ).drop("__min")


def derive_summary_records(df: DataFrame, by: Sequence[str], where: str, fn: str, set_values: Mapping) -> DataFrame:
    """Add one row per group with the sum, mean, min or max of AVAL over the chosen records."""
    agg = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max}[fn]
    rows = df.filter(where).groupBy(*by).agg(agg("AVAL").alias("AVAL")).withColumns(_lit_row(set_values))
    return df.unionByName(rows, allowMissingColumns=True)


def derive_param(df: DataFrame, by: Sequence[str], inputs: Mapping[str, str], formula: Column,
                 set_values: Mapping) -> DataFrame:
    """Add a parameter computed from others of the same group, where all inputs are present.

    ``inputs`` maps a column name used in ``formula`` to the PARAMCD it stands for.
    A repeated input in one group is taken at its greatest value.
    """
    wide = df.filter(F.col("PARAMCD").isin(*inputs.values())).groupBy(*by).agg(
        *[F.max(F.when(F.col("PARAMCD") == code, F.col("AVAL"))).alias(name) for name, code in inputs.items()]
    )
    rows = wide.withColumn("AVAL", formula).filter(F.col("AVAL").isNotNull()).drop(*inputs)
    return df.unionByName(rows.withColumns(_lit_row(set_values)), allowMissingColumns=True)


def derive_bmi(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return derive_param(df, by, {"__w": "WEIGHT", "__h": "HEIGHT"}, bmi("__w", "__h"),
                        {"PARAMCD": "BMI", "PARAM": "Body Mass Index (kg/m2)"})


def derive_bsa(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return derive_param(df, by, {"__w": "WEIGHT", "__h": "HEIGHT"}, bsa("__w", "__h"),
                        {"PARAMCD": "BSA", "PARAM": "Body Surface Area (m2)"})


def exposure_params(ex: DataFrame, by: Sequence[str] = SUBJECT, dose: str = "EXDOSE", start: str = "EXSTDT",
                    end: str = "EXENDT") -> DataFrame:
    """TRTDUR, CUMD, AVGDD and DOSE (largest single dose) as one row per parameter."""
    facts = ex.groupBy(*by).agg(
        F.min(start).alias("__s"), F.max(end).alias("__e"), F.sum(dose).alias("CUMD"), F.max(dose).alias("DOSE")
    ).withColumn("TRTDUR", (F.datediff("__e", "__s") + 1).cast("double")).withColumn(
        "AVGDD", F.try_divide("CUMD", "TRTDUR"))
    return facts.withColumns({"CUMD": F.col("CUMD").cast("double"), "DOSE": F.col("DOSE").cast("double")}).unpivot(
        list(by), ["TRTDUR", "CUMD", "AVGDD", "DOSE"], "PARAMCD", "AVAL")


def disposition(adsl: DataFrame, ds: DataFrame, order: Sequence[str] = ("DSDT", "DSSEQ"),
                completed: str = "COMPLETED") -> DataFrame:
    """EOSSTT, DCSREAS and COMP26FL from the last disposition record."""
    last = extreme_rows(ds, SUBJECT, list(order), "last", keep=["DSDECOD"])
    done = F.col("DSDECOD") == completed
    return keyed_join(adsl, last, SUBJECT).withColumns({
        "EOSSTT": F.when(done, F.lit("COMPLETED")).when(F.col("DSDECOD").isNotNull(), F.lit("DISCONTINUED")),
        "DCSREAS": F.when(~done, F.col("DSDECOD")),
        "COMP26FL": F.when(F.coalesce(done, F.lit(False)), F.lit("Y")).otherwise(F.lit("N")),
    }).drop("DSDECOD")


def baseline_value(adsl: DataFrame, findings: DataFrame, where: str | Column, value: str, new_var: str,
                   order: Sequence[str]) -> DataFrame:
    """Merge the latest chosen screening or baseline value onto the subject."""
    picked = extreme_rows(findings.filter(where), SUBJECT, list(order), "last", keep=[value])
    return keyed_join(adsl.drop(new_var), picked.withColumnRenamed(value, new_var), SUBJECT)


def earliest(adsl: DataFrame, records: DataFrame, where: str | Column, date: str, new_var: str) -> DataFrame:
    """Merge the earliest chosen date onto the subject."""
    facts = records.filter(where).groupBy(*SUBJECT).agg(F.min(date).alias(new_var))
    return keyed_join(adsl.drop(new_var), facts, SUBJECT)


def death(adsl: DataFrame, *sources: tuple[DataFrame, str | Column, str]) -> DataFrame:
    """DTHDT, the first date over sources in the given order of trust, and DTHFL.

    Each source is (records, condition, date column); ``adsl`` may itself carry
    DTHDT, which is then trusted most.
    """
    out, picks = adsl, ["DTHDT"] if "DTHDT" in adsl.columns else []
    for i, (records, cond, date) in enumerate(sources):
        facts = records.filter(cond).groupBy(*SUBJECT).agg(F.min(date).alias(f"__d{i}"))
        out = keyed_join(out, facts, SUBJECT)
        picks.append(f"__d{i}")
    out = out.withColumn("DTHDT", F.coalesce(*[F.col(p) for p in picks]))
    return out.withColumn("DTHFL", F.when(F.col("DTHDT").isNotNull(), F.lit("Y"))).drop(
        *[p for p in picks if p != "DTHDT"])


def custom_query(df: DataFrame, name: str, terms: Sequence[str] = (), pattern: str | None = None,
                 column: str = "AEDECOD", new_var: str = "CQ01NAM") -> DataFrame:
    """Name records whose term is in a list or matches a pattern."""
    hit = F.lit(False)
    if terms:
        hit = hit | F.upper(column).isin(*[t.upper() for t in terms])
    if pattern:
        hit = hit | F.col(column).rlike(pattern)
    return df.withColumn(new_var, F.when(hit, F.lit(name)))


def hys_law(adlb: DataFrame, by: Sequence[str] = ("USUBJID", "AVISITN"), transaminases: Sequence[str] = ("ALT", "AST"),
            bilirubin: str = "BILI", k_trans: float = 3.0, k_bili: float = 2.0) -> DataFrame:
    """Per group: transaminase and bilirubin criteria and their conjunction."""
    over = lambda k: F.col("AVAL") > k * F.col("A1HI")
    trans = F.col("PARAMCD").isin(*transaminases) & over(k_trans)
    bili = (F.col("PARAMCD") == bilirubin) & over(k_bili)
    yn = lambda c: F.when(F.coalesce(c, F.lit(False)), F.lit("Y")).otherwise(F.lit("N"))
    return (
        adlb.filter(F.col("PARAMCD").isin(*transaminases, bilirubin))
        .groupBy(*by)
        .agg(F.bool_or(trans).alias("__t"), F.bool_or(bili).alias("__b"))
        .select(*by, yn(F.col("__t")).alias("TRANSFL"), yn(F.col("__b")).alias("BILIFL"),
                yn(F.col("__t") & F.col("__b")).alias("HYSLAWFL"))
    )


def flag_lab_criterion(adlb: DataFrame, limits: Mapping[str, float], new_var: str = "CRIT1FL") -> DataFrame:
    """Per record: ABNORMAL above the parameter's multiple of the upper limit, else NORMAL."""
    hit = F.lit(False)
    for code, k in limits.items():
        hit = hit | ((F.col("PARAMCD") == code) & (F.col("AVAL") > k * F.col("A1HI")))
    return adlb.filter(F.col("PARAMCD").isin(*limits)).withColumn(
        new_var, F.when(hit, F.lit("ABNORMAL")).otherwise(F.lit("NORMAL")))


@dataclass(frozen=True)
class Source:
    """One event or censoring source: records, the condition, the date and its description."""

    records: DataFrame
    date: str
    description: str
    where: str | None = None
    censor_description: str | None = None

    def dates(self, rank: int) -> DataFrame:
        df = self.records if self.where is None else self.records.filter(self.where)
        return df.select(
            "USUBJID", F.col(self.date).cast("date").alias("__date"), F.lit(rank).alias("__rank"),
            F.lit(self.description).alias("__desc"), F.lit(self.censor_description).alias("__cdesc"),
        ).filter(F.col("__date").isNotNull())


def derive_tte(adsl: DataFrame, start: str, events: Sequence[Source], censors: Sequence[Source],
               set_values: Mapping, keep: Sequence[str] = ("ARM",), where: str | None = None) -> DataFrame:
    """Time to the earliest event, else to the latest censoring date, in inclusive days.

    Dates before the origin are ignored; subjects without an origin, an event and a
    censoring date are dropped. Among sources with the same date the earlier in the
    list wins.
    """
    base = adsl if where is None else adsl.filter(where)
    base = base.filter(F.col(start).isNotNull()).select(
        "USUBJID", F.col(start).cast("date").alias("STARTDT"), *keep)

    def best(sources: Sequence[Source], mode: str) -> DataFrame:
        stacked = reduce(DataFrame.unionByName, [s.dates(i) for i, s in enumerate(sources)])
        within = keyed_join(stacked, base.select("USUBJID", "STARTDT"), SUBJECT, "inner").filter(
            F.col("__date") >= F.col("STARTDT"))
        row = F.struct("__date", "__desc", "__cdesc")
        if mode == "first":
            picked = F.min_by(row, F.struct("__date", "__rank"))
        else:
            picked = F.max_by(row, F.struct(F.col("__date"), -F.col("__rank")))
        return within.groupBy("USUBJID").agg(picked.alias(f"__{mode}"))

    joined = keyed_join(keyed_join(base, best(events, "first"), SUBJECT), best(censors, "last"), SUBJECT)
    e, c = F.col("__first"), F.col("__last")
    is_event = e.isNotNull()
    return (
        joined.filter(is_event | c.isNotNull())
        .withColumns({
            "ADT": F.when(is_event, e["__date"]).otherwise(c["__date"]),
            "CNSR": F.when(is_event, F.lit(0)).otherwise(F.lit(1)),
            "EVNTDESC": F.when(is_event, e["__desc"]).otherwise(c["__desc"]),
            "CNSDTDSC": F.when(~is_event, c["__cdesc"]),
        })
        .withColumn("AVAL", F.datediff("ADT", "STARTDT") + 1)
        .withColumns(_lit_row(set_values))
        .drop("__first", "__last")
    )


def oncology_tte(adsl: DataFrame, responses: DataFrame, start: str = "RANDDT", keep: Sequence[str] = ("ARM",)) -> DataFrame:
    """OS, PFS, DOR and TTR rows.

    ``adsl`` carries DTHDT and LSTALVDT, ``responses`` has ADT and AVALC (CR, PR, SD,
    PD, NE). DOR starts at first response and is for responders only.
    """
    progression = Source(responses, "ADT", "Progression", "AVALC = 'PD'")
    dead = Source(adsl, "DTHDT", "Death")
    response = Source(responses, "ADT", "Response", "AVALC IN ('CR', 'PR')")
    alive = Source(adsl, "LSTALVDT", "Alive", None, "Last known alive date")
    assessed = Source(responses, "ADT", "No event", "AVALC <> 'NE'", "Last adequate assessment")
    first_response = responses.filter("AVALC IN ('CR', 'PR')").groupBy("USUBJID").agg(F.min("ADT").alias("__RSPDT"))
    responders = keyed_join(adsl, first_response, SUBJECT, "inner")
    parts = [
        derive_tte(adsl, start, [dead], [alive], {"PARAMCD": "OS", "PARAM": "Overall Survival"}, keep),
        derive_tte(adsl, start, [progression, dead], [assessed],
                   {"PARAMCD": "PFS", "PARAM": "Progression-Free Survival"}, keep),
        derive_tte(responders, "__RSPDT", [progression, dead], [assessed],
                   {"PARAMCD": "DOR", "PARAM": "Duration of Response"}, keep),
        derive_tte(adsl, start, [response], [assessed], {"PARAMCD": "TTR", "PARAM": "Time to Response"}, keep),
    ]
    return reduce(DataFrame.unionByName, parts)


# Response categories, best first.
RESPONSE_ORDER = {"CR": 1, "PR": 2, "SD": 3, "PD": 4, "NE": 5}


def best_response(adrs: DataFrame, confirm_days: int | None = None, by: Sequence[str] = SUBJECT) -> DataFrame:
    """Best overall response; with ``confirm_days`` a CR or PR needs a later one at least that far on.

    A CR is confirmed by a CR, a PR by a PR or CR. For the earliest response of a
    kind to be confirmed it is enough that the latest confirming date lies far
    enough after it, so two dates per group decide and no pairs are formed. An
    unconfirmed response counts as SD.
    """
    rank = reduce(lambda w, kv: w.when(F.col("AVALC") == kv[0], kv[1]), list(RESPONSE_ORDER.items())[1:],
                  F.when(F.col("AVALC") == "CR", 1))
    ranked = adrs.withColumn("__r", rank).filter(F.col("__r").isNotNull())
    if confirm_days is None:
        best = ranked.groupBy(*by).agg(F.min("__r").alias("AVAL"))
    else:
        date = lambda fn, *codes: fn(F.when(F.col("AVALC").isin(*codes), F.col("ADT")))
        facts = ranked.groupBy(*by).agg(
            date(F.min, "CR").alias("cr0"), date(F.max, "CR").alias("cr1"),
            date(F.min, "PR").alias("pr0"), date(F.max, "CR", "PR").alias("any1"),
            F.min(F.when(F.col("__r") > 2, F.col("__r"))).alias("other"),
        )
        far = lambda a, b: F.coalesce(F.datediff(F.col(b), F.col(a)) >= confirm_days, F.lit(False))
        responded = F.col("cr0").isNotNull() | F.col("pr0").isNotNull()
        best = facts.withColumn(
            "AVAL",
            F.when(far("cr0", "cr1"), 1).when(far("pr0", "any1"), 2).when(responded, 3).otherwise(F.col("other")),
        ).select(*by, "AVAL")
    label = F.element_at(F.array(*[F.lit(k) for k in RESPONSE_ORDER]), F.col("AVAL").cast("int"))
    return best.withColumn("AVALC", label).withColumn("PARAMCD", F.lit("BOR" if confirm_days is None else "CBOR"))


def timepoint_params(vs: DataFrame, test: str = "VSTESTCD", position: str = "VSPOS", timepoint: str = "ATPT") -> DataFrame:
    """Position- and timepoint-qualified parameters: one row per subject, parameter and day, averaged."""
    code = F.concat_ws("_", F.col(test), F.col(position), F.col(timepoint))
    return vs.withColumn("PARAMCD", code).groupBy("USUBJID", "PARAMCD", "ADT").agg(F.avg("AVAL").alias("AVAL"))


def occurrence_dataset(domain: DataFrame, adsl: DataFrame, start: str, end: str | None, adsl_vars: Sequence[str],
                       highest: str | None = "M", overlap: bool = False) -> DataFrame:
    """Occurrence table of a domain: dates from text, subject variables, study days, optional overlap flags."""
    out = derive_dt(domain, start, "AST", highest=highest)
    out = derive_dt(out, end, "AEN", highest=highest, date_imputation="last") if end else out.withColumn(
        "AENDT", F.lit(None).cast("date"))
    out = keyed_join(out, adsl.select("USUBJID", *adsl_vars), SUBJECT)
    out = out.withColumns({"ASTDY": study_day("ASTDT", "TRTSDT"), "AENDY": study_day("AENDT", "TRTSDT")})
    return flag_overlap(out) if overlap else out


def derive_extreme_records(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], mode: str,
                           set_values: Mapping, where: str | Column | None = None) -> DataFrame:
    """Add the first or last chosen row per group as a new row with set values."""
    rows = extreme_rows(df if where is None else df.filter(where), by, order, mode, keep=df.columns)
    return df.unionByName(rows.withColumns(_lit_row(set_values)), allowMissingColumns=True)


def toxicity_grade(df: DataFrame, criteria: DataFrame, by: Sequence[str] = ("USUBJID", "PARAMCD"),
                   flag: str = "ABLFL") -> DataFrame:
    """ATOXGR, the highest grade whose range holds the value, and BTOXGR at baseline.

    ``criteria`` has PARAMCD, GRADE, LOWER, UPPER (lower bound open, upper closed; null
    for no bound). It is a published grading table, a few rows per laboratory test, so
    it is turned into one map per test and looked up without repeating records.
    """
    lists = criteria.groupBy("PARAMCD").agg(
        F.sort_array(F.collect_list(F.struct(F.col("GRADE"), F.col("LOWER"), F.col("UPPER"))), asc=False).alias("__g"))
    joined = keyed_join(df, lists, ["PARAMCD"])
    holds = "filter(__g, g -> (g.LOWER IS NULL OR AVAL > g.LOWER) AND (g.UPPER IS NULL OR AVAL <= g.UPPER))"
    grade = F.when(F.col("AVAL").isNotNull() & F.col("__g").isNotNull(),
                   F.coalesce(F.expr(f"try_element_at({holds}, 1).GRADE"), F.lit(0)))
    out = joined.withColumn("ATOXGR", grade.cast("int")).drop("__g")
    facts = out.filter(F.col(flag) == "Y").groupBy(*by).agg(F.max("ATOXGR").alias("BTOXGR"))
    return keyed_join(out, facts, by)
