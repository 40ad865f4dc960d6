"""Rule tables of the output portfolio.

Fixed values: ids, titles, gates, methods and sources that results must carry as
they are, in the order in which outputs are listed.
"""

# slug, title, type, category, rule, gate flag ("" is always), population
SCAFFOLDING = [
    ("reg-populations-summary", "Summary of Populations", "Table", "disposition", "ICH E3 §11.1", "", "All Subjects"),
    ("reg-disposition-eos", "Summary of End of Study Data", "Table", "disposition", "ICH E3 §10.1", "", "Intent-to-Treat"),
    ("reg-subjects-by-site", "Summary of Number of Subjects by Site", "Table", "disposition", "ICH E3 §10.1", "multi_site", "All Subjects"),
    ("reg-demographics-baseline", "Summary of Demographic and Baseline Characteristics", "Table", "demographics", "ICH E3 §11.2", "", "Intent-to-Treat"),
    ("reg-exposure-planned", "Summary of Planned Exposure to Study Drug", "Table", "exposure", "ICH E3 §12.1", "", "Safety"),
    ("reg-conmeds-summary", "Summary of Concomitant Medications", "Table", "conmeds", "ICH E3 §11.2", "", "Safety"),
    ("reg-medical-history", "Summary of Medical History", "Table", "disposition", "ICH E3 §11.2", "medical_history_available", "All Subjects"),
    ("reg-protocol-deviations", "Summary of Important Protocol Deviations", "Table", "disposition", "ICH E3 §10.2", "deviations_tracked", "All Subjects"),
    ("reg-deaths-listing", "Listing of Deaths", "Listing", "disposition", "ICH E3 §12.3", "not_covered_by_safety", "Safety"),
    ("reg-sae-listing", "Listing of Serious Adverse Events", "Listing", "disposition", "ICH E3 §12.3", "not_covered_by_safety", "Safety"),
    ("reg-ae-discontinuation-listing", "Listing of AEs Leading to Discontinuation", "Listing", "disposition", "ICH E3 §12.3", "not_covered_by_safety", "Safety"),
]

# measure type, objective level, role, method, type, one per stated timepoint, imputation rule ("strategy" or "none"), priority
EFFICACY = [
    ("continuous", "Primary", "ancova", "ANCOVA", "Table", False, "strategy", "primary"),
    ("continuous", "Primary", "mmrm", "MMRM", "Table", False, "none", "primary"),
    ("continuous", "Primary", "over-time", "Descriptive", "Table", False, "none", "supportive"),
    ("continuous", "Secondary", "ancova", "ANCOVA", "Table", True, "strategy", "secondary"),
    ("continuous", "Exploratory", "descriptive", "Descriptive", "Table", False, "none", "supportive"),
    ("global-impression", "Primary", "summary", "ANOVA", "Table", False, "strategy", "primary"),
    ("global-impression", "Primary", "categorical", "CMH", "Table", False, "strategy", "primary"),
    ("global-impression", "Secondary", "summary", "ANOVA", "Table", True, "strategy", "secondary"),
    ("global-impression", "Exploratory", "descriptive", "Descriptive", "Table", False, "none", "supportive"),
    ("categorical", "Primary", "summary", "Descriptive", "Table", False, "none", "primary"),
    ("categorical", "Primary", "categorical", "CMH", "Table", False, "strategy", "primary"),
    ("categorical", "Secondary", "summary", "Descriptive", "Table", True, "none", "secondary"),
    ("categorical", "Exploratory", "descriptive", "Descriptive", "Table", False, "none", "supportive"),
    ("ordinal", "Primary", "summary", "Descriptive", "Table", False, "none", "primary"),
    ("ordinal", "Primary", "categorical", "CMH", "Table", False, "strategy", "primary"),
    ("ordinal", "Secondary", "summary", "Descriptive", "Table", True, "none", "secondary"),
    ("ordinal", "Exploratory", "descriptive", "Descriptive", "Table", False, "none", "supportive"),
    ("event", "Primary", "km", "KaplanMeier", "Figure", False, "none", "primary"),
    ("event", "Primary", "logrank", "LogRank", "Table", False, "none", "primary"),
    ("event", "Primary", "cox", "Cox", "Table", False, "none", "primary"),
    ("event", "Primary", "summary", "Descriptive", "Table", False, "none", "supportive"),
    ("event", "Secondary", "km", "KaplanMeier", "Figure", False, "none", "secondary"),
    ("event", "Secondary", "summary", "Descriptive", "Table", False, "none", "secondary"),
    ("event", "Exploratory", "km", "KaplanMeier", "Figure", False, "none", "supportive"),
    ("count", "Primary", "model", "none", "Table", False, "none", "primary"),
    ("count", "Primary", "summary", "Descriptive", "Table", False, "none", "supportive"),
    ("count", "Secondary", "summary", "Descriptive", "Table", False, "none", "secondary"),
    ("count", "Exploratory", "summary", "Descriptive", "Table", False, "none", "supportive"),
]

# intercurrent-event strategy and the imputation it leads to
STRATEGY_IMPUTATION = {"Treatment Policy": "LOCF", "Hypothetical": "MI", "Composite": "none", "While-on-Treatment": "none",
                       "Principal Stratum": "none"}

# domain hint, slug, title, type, method, category, gate flag, comparison
SAFETY = [
    ("safety-ae", "teae-incidence-soc-pt", "Incidence of Treatment-Emergent Adverse Events by Treatment Group", "Table", "Incidence", "safety-ae", "", ""),
    ("safety-ae", "sae-incidence", "Incidence of Treatment-Emergent Serious Adverse Events by Treatment Group", "Table", "Incidence", "safety-ae", "", ""),
    ("safety-ae", "ae-discontinuation", "Adverse Events Leading to Discontinuation", "Table", "Incidence", "safety-ae", "reports_ae_discontinuation", ""),
    ("safety-ae", "deaths", "Deaths", "Table", "Incidence", "safety-ae", "reports_deaths", ""),
    ("safety-ae", "ae-max-severity", "Adverse Events by Maximum Severity", "Table", "Incidence", "safety-ae", "reports_ae_severity", ""),
    ("safety-ae", "km-time-to-derm-event", "Time to Dermatologic Event by Treatment Group", "Figure", "KaplanMeier", "safety-ae", "needs_tte_safety_figure", "log-rank"),
    ("safety-vs", "baseline-eot", "Summary of Vital Signs at Baseline and End of Treatment", "Table", "Descriptive", "safety-vs", "", ""),
    ("safety-vs", "cfb-eot", "Summary of Vital Signs Change from Baseline at End of Treatment", "Table", "Descriptive", "safety-vs", "", ""),
    ("safety-vs", "weight-cfb-eot", "Summary of Weight Change from Baseline at End of Treatment", "Table", "Descriptive", "safety-vs", "", ""),
    ("safety-lab", "continuous-summary", "Summary Statistics for Continuous Laboratory Values", "Table", "Descriptive", "safety-lab", "", ""),
    ("safety-lab", "freq-normal-abnormal-range", "Frequency of Normal and Abnormal (Beyond Normal Range) Laboratory Values During Treatment", "Table", "ShiftTable", "safety-lab", "", ""),
    ("safety-lab", "freq-normal-abnormal-csc", "Frequency of Normal and Abnormal (Clinically Significant Change from Previous Visit) Laboratory Values During Treatment", "Table", "ShiftTable", "safety-lab", "", ""),
    ("safety-lab", "shift-threshold-byvisit", "Shifts of Laboratory Values During Treatment, Categorized Based on Threshold Ranges, by Visit", "Table", "ShiftTable", "safety-lab", "", "Cochran-Mantel-Haenszel"),
    ("safety-lab", "shift-threshold-overall", "Shifts of Laboratory Values During Treatment, Categorized Based on Threshold Ranges", "Table", "ShiftTable", "safety-lab", "", "Cochran-Mantel-Haenszel"),
    ("safety-lab", "shift-hys-law", "Shifts of Hy's Law Values During Treatment", "Table", "ShiftTable", "safety-lab", "", ""),
    ("safety-ecg", "ecg-summary", "ECG (QT/QTc) Summary and Change from Baseline", "Table", "Descriptive", "safety-vs", "", ""),
    ("safety-ecg", "ecg-shifts", "ECG Shifts", "Table", "ShiftTable", "safety-vs", "", ""),
]

# slug, title, type, method, category, gate flag, analysis sources, raw sources
SPECIAL = [
    ("pk-conc-time-summary", "Summary of Plasma Concentrations by Nominal Time and Dose", "Table", "Descriptive", "pk", "needs_pk", "ADPC", "PC,PP"),
    ("pk-conc-time-fig-lin", "Mean Concentration-Time Profile (Linear Scale) by Dose", "Figure", "Descriptive", "pk", "needs_pk", "ADPC", "PC"),
    ("pk-conc-time-fig-log", "Mean Concentration-Time Profile (Semi-Log Scale) by Dose", "Figure", "Descriptive", "pk", "needs_pk", "ADPC", "PC"),
    ("pk-param-summary", "Summary of PK Parameters by Dose", "Table", "Descriptive", "pk", "needs_pk", "ADPP", "PP"),
    ("pk-trough-steady-state", "Summary of Trough (Ctrough) Concentrations by Visit", "Table", "Descriptive", "pk", "needs_pk", "ADPC", "PC"),
    ("pk-param-listing", "Individual PK Parameters by Subject and Dose", "Listing", "none", "pk", "needs_pk", "ADPP", "PP"),
    ("pd-marker-summary", "Summary of Pharmacodynamic Marker by Time and Dose", "Table", "Descriptive", "pk", "needs_pd", "ADPD", ""),
    ("pd-conc-effect-fig", "Concentration-Effect (PK/PD) Relationship by Dose", "Figure", "Descriptive", "pk", "needs_pd", "ADPC,ADPD", ""),
    ("onc-recist-bor", "Best Overall Response per RECIST v1.1 by Treatment", "Table", "Incidence", "other", "needs_oncology_response", "ADRS", "RS"),
    ("onc-orr-ci", "Objective Response Rate with 95% CI by Treatment", "Table", "Incidence", "other", "needs_oncology_response", "ADRS", "RS"),
    ("onc-dcr-ci", "Disease Control Rate with 95% CI by Treatment", "Table", "Incidence", "other", "needs_oncology_response", "ADRS", "RS"),
    ("onc-dor-summary", "Duration of Response - Kaplan-Meier Survival Summary", "Table", "KaplanMeier", "other", "needs_oncology_response", "ADTTE", "RS"),
    ("onc-pfs-km-table", "Progression-Free Survival - Kaplan-Meier Survival Summary", "Table", "KaplanMeier", "other", "needs_oncology_response", "ADTTE", ""),
    ("onc-pfs-km-fig", "Progression-Free Survival Kaplan-Meier Survival Curve with Number at Risk", "Figure", "KaplanMeier", "other", "needs_oncology_response", "ADTTE", ""),
    ("onc-os-km-table", "Overall Survival - Kaplan-Meier Survival Summary", "Table", "KaplanMeier", "other", "needs_oncology_response", "ADTTE", ""),
    ("onc-os-km-fig", "Overall Survival Kaplan-Meier Survival Curve with Number at Risk", "Figure", "KaplanMeier", "other", "needs_oncology_response", "ADTTE", ""),
    ("onc-waterfall", "Waterfall Plot of Best Percent Change in Tumor Burden", "Figure", "Descriptive", "other", "needs_oncology_response", "ADTR", "TR"),
    ("onc-spider", "Spider Plot of Tumor Burden Change Over Time", "Figure", "Descriptive", "other", "needs_oncology_response", "ADTR", "TR"),
    ("onc-swimmer", "Swimmer Plot of Response Duration by Subject", "Figure", "Descriptive", "other", "needs_oncology_response", "ADRS,ADTTE", ""),
    ("onc-response-listing", "Individual Tumor Response by Subject and Visit", "Listing", "none", "other", "needs_oncology_response", "ADTR,ADRS", ""),
    ("immuno-ada-incidence", "Incidence of Anti-Drug Antibodies by Treatment", "Table", "Incidence", "other", "needs_immunogenicity", "ADIS", "IS"),
    ("immuno-ada-titer", "Summary of ADA Titers Among ADA-Positive Subjects", "Table", "Descriptive", "other", "needs_immunogenicity", "ADIS", "IS"),
    ("immuno-nab", "Incidence of Neutralizing Antibodies Among ADA-Positive Subjects", "Table", "Incidence", "other", "needs_immunogenicity", "ADIS", "IS"),
    ("immuno-ada-listing", "Individual ADA / nAb Results by Subject and Visit", "Listing", "none", "other", "needs_immunogenicity", "ADIS", "IS"),
    ("pro-domain-summary", "Summary of Domain Scores by Visit and Treatment", "Table", "Descriptive", "pro", "needs_pro_hrqol", "ADQS", "QS"),
    ("pro-cfb", "Change from Baseline in Domain Scores by Visit and Treatment", "Table", "Descriptive", "pro", "needs_pro_hrqol", "ADQS", "QS"),
    ("pro-cfb-fig", "Mean Change from Baseline in Score Over Time by Treatment", "Figure", "Descriptive", "pro", "needs_pro_hrqol", "ADQS", "QS"),
    ("pro-responder", "Responder Analysis by Treatment", "Table", "Incidence", "pro", "needs_pro_hrqol", "ADQS", "QS"),
    ("pro-completion", "Questionnaire Completion Rates by Visit", "Table", "Descriptive", "pro", "needs_pro_hrqol", "ADQS", "QS"),
]

# indication keywords, indication, therapeutic area
INDICATIONS = [
    ("(?i)adas-cog|cibic|npi-x|\\bdad\\b|mmse|cognition|alzheimer|dementia|xanomeline", "Alzheimer's Disease", "CNS"),
    ("(?i)tumor response|recist|\\borr\\b|\\bpfs\\b|\\bos\\b|carcinoma|lymphoma", "Cancer", "Oncology"),
    ("(?i)hba1c|fasting glucose|insulin|diabetes", "Diabetes", "Metabolic"),
    ("(?i)\\bldl\\b|ejection fraction|\\bmace\\b|heart failure", "Cardiovascular", "Cardiology"),
    ("(?i)fev1|asthma|copd|exacerbation", "Respiratory", "Respiratory"),
    ("(?i)\\bpasi\\b|\\beasi\\b|psoriasis|atopic dermatitis|eczema", "Skin", "Dermatology"),
    ("(?i)viral load|\\bcd4\\b|bacterial culture", "Infection", "Infectious Disease"),
    ("(?i)das28|acr20|lupus|\\bibd\\b|crohn", "Immune", "Immunology"),
]

# flag and the keywords that set it
FLAG_KEYWORDS = {
    "needs_pk": "(?i)pharmacokinetic|\\bpk\\b|concentration|cmax|tmax|\\bauc|half-life|clearance|\\bcl\\b|\\bvd\\b",
    "needs_pd": "(?i)pharmacodynamic|\\bpd\\b|target engagement|receptor occupancy|biomarker response",
    "needs_immunogenicity": "(?i)immunogenicity|anti-drug antibod|\\bada\\b|neutralizing antibod|\\bnab\\b",
    "needs_pro_hrqol": "(?i)patient-reported|\\bpro\\b|quality of life|hrqol|eq-5d|sf-36|eortc qlq|promis|vas pain",
    "needs_tte_safety_figure": "(?i)time to (dermatologic|application|injection|skin)|dermatologic event",
    "onc_words": "(?i)\\borr\\b|objective response|\\bdor\\b|\\bpfs\\b|\\bos\\b|recist|tumor response|best overall response",
    "has_ecg": "(?i)\\becg\\b|electrocardiogram",
    "region_words": "(?i)multi-?national|multi-?region|by (geographic )?region|stratified by (region|geograph)",
    "sex_words": "(?i)\\b(by|sub-?groups? of) sex\\b|\\bsex sub-?group|sub-?groups?:? sex\\b",
    "reports_ae_discontinuation": "(?i)(lead|led|leading) to (study )?(drug )?(discontinu|withdraw)|discontinu\\w* due to",
    "reports_deaths": "(?i)\\bdeaths?\\b|mortality|fatal",
    "reports_ae_severity": "(?i)severity|\\bsevere\\b|ctcae|toxicity grade",
    "crossover_words": "(?i)crossover|washout|period 1",
}

# category, raw domain required, analysis data set, section
CATEGORIES = [
    ("disposition", "DM,DS", "ADSL", "14-1"),
    ("demographics", "DM", "ADSL", "14-2"),
    ("efficacy", "QS", "ADQS", "14-3"),
    ("pro", "QS", "ADQS", "14-3"),
    ("exposure", "EX", "ADEX", "14-4"),
    ("pk", "PC,PP", "ADPC,ADPP", "14-4"),
    ("safety-ae", "AE", "ADAE", "14-5"),
    ("safety-lab", "LB", "ADLB", "14-6"),
    ("safety-vs", "VS", "ADVS", "14-7"),
    ("conmeds", "CM", "ADCM", "14-7"),
]

# signal prefix of an endpoint and the phase a gap is routed to
ROUTES = [("efficacy", "efficacy"), ("safety", "safety"), ("pk", "special domains"), ("other", "special domains")]

# completeness heuristics: id, what is recommended, phase that owns it
COMPLETENESS = {
    "C1": ("add deaths summary", "safety"),
    "C2": ("add discontinuation-AE table", "safety"),
    "C3": ("add sensitivity analysis", "variants"),
    "C4": ("add MMRM", "efficacy"),
    "C5": ("add subgroup variants", "variants"),
    "C6": ("add by-site table", "scaffolding"),
    "C7": ("add shift/Hy's-Law tables", "safety"),
    "C8": ("add scaffolding", "scaffolding"),
    "C9": ("add KM figure", "safety"),
    "C10": ("add exposure table", "scaffolding"),
}

# population label, flag condition
POPULATIONS = {
    "Efficacy": "EFFFL = 'Y'", "Safety": "SAFFL = 'Y'", "Intent-to-Treat": "ITTFL = 'Y'", "Completers": "COMPLFL = 'Y'",
    "All Subjects": "",
}

# imputation, record flag condition
IMPUTATION_FLAGS = {"LOCF": "ANL01FL = 'Y'", "OC": "ANL02FL = 'Y'", "none": "DTYPE IS NULL"}

# fixed values: population and imputation as (flag, value); "All Subjects" has no flag
POPULATION_FLAGS = {"Efficacy": ("EFFFL", "Y"), "Safety": ("SAFFL", "Y"), "Intent-to-Treat": ("ITTFL", "Y"), "Completers": ("COMPLFL", "Y")}
RECORD_FLAGS = {"LOCF": ("ANL01FL", "Y"), "OC": ("ANL02FL", "Y")}

# fixed values: planner method and its analysis methods; what a comparison adds; operations of a method
METHOD_TYPES = {
    "Descriptive": ["Descriptive"], "Incidence": ["Incidence"], "ShiftTable": ["ShiftTable"], "ANOVA": ["Descriptive", "ANOVA"],
    "ANCOVA": ["Descriptive", "ANCOVA"], "CMH": ["CMH"], "Fisher": ["Fisher"], "ChiSquare": ["ChiSquare"], "KaplanMeier": ["KaplanMeier"],
    "LogRank": ["LogRank"], "Cox": ["Cox"], "MMRM": ["MMRM", "Descriptive"], "none": [],
}
METHOD_ADDITIONS = [("ShiftTable", "cmh", "CMH"), ("ANCOVA", "dose-response", "DoseResponse"), ("KaplanMeier", "log-rank", "LogRank")]
METHOD_OPERATIONS = {
    "Descriptive": ["N", "mean", "sd", "median", "min", "max"], "Incidence": ["n", "events", "N", "p"], "ShiftTable": ["n", "N", "p"],
    "ANOVA": ["statistic", "p.value"], "ANCOVA": ["lsmean", "lsmean_se", "diff", "diff_se", "conf.low", "conf.high", "p.value"], "CMH": ["p.value"],
    "Fisher": ["p.value"], "ChiSquare": ["statistic", "p.value"], "KaplanMeier": ["n.risk", "n.event", "estimate", "median"],
    "LogRank": ["statistic", "p.value"], "Cox": ["estimate", "conf.low", "conf.high", "p.value"],
    "MMRM": ["lsmean", "lsmean_se", "diff", "diff_se", "conf.low", "conf.high", "p.value"], "DoseResponse": ["p.value"],
}
