"""Fixed lists the reporting rules refer to. Callers may pass their own instead."""

# Areas flagged as high burden.
HIGH_BURDEN_AREAS = (
    "gp City of Johannesburg Metropolitan Municipality",
    "gp City of Tshwane Metropolitan Municipality",
    "gp Ekurhuleni Metropolitan Municipality",
    "kz eThekwini Metropolitan Municipality",
    "wc City of Cape Town Metropolitan Municipality",
)

# Prioritization classes of focus districts.
FOCUS_PRIORITIES = (
    "2 - Scale-Up: Aggressive",
    "1 - Scale-Up: Saturation",
)

# Areas of the original prevention programme.
ORIGINAL_PROGRAMME_AREAS = (
    "gp City of Johannesburg Metropolitan Municipality",
    "gp Ekurhuleni Metropolitan Municipality",
    "kz eThekwini Metropolitan Municipality",
    "kz uMgungundlovu District Municipality",
)

# Prevention partner label by (mechanism code, indicator group).
PREVENTION_PARTNERS = {
    ("70301", "PrEP"): "Wits DSP",
    ("70287", "PrEP"): "Broadreach",
    ("70290", "PrEP"): "Right to Care",
    ("70310", "PrEP"): "ANOVA",
    ("80007", "PrEP"): "Wits Prevention",
    ("81891", "PrEP"): "Shout it Now",
    ("81902", "PrEP"): "MatCH",
    ("83013", "PrEP"): "TB/HIV Care",
    ("80002", "OVC"): "NACOSA OVC",
    ("80008", "OVC"): "NACOSA GBV",
    ("81904", "OVC"): "Dept of Social Development",
}
PREVENTION_GROUPS = {
    "PrEP_NEW": "PrEP",
    "PrEP_CURR": "PrEP",
    "OVC_SERV": "OVC",
    "OVC_HIVSTAT": "OVC",
}

# Fixed values: (cadre, delivery model) pairs of community workers. Some cadres
# count in every listed model, some only in two, two in any model.
COMMUNITY_MODELS_ALL = (
    "Community-based",
    "Facility site - Roving",
    "Facility site - Seconded",
    "Facility site - Surge",
    "Ward Based Outreach Team - WBOT",
)
COMMUNITY_MODELS_OUTREACH = (
    "Community-based",
    "Ward Based Outreach Team - WBOT",
)
COMMUNITY_CADRES = {
    "Community Development Workers": COMMUNITY_MODELS_ALL,
    "Community health workers": COMMUNITY_MODELS_ALL,
    "Community navigator": COMMUNITY_MODELS_ALL,
    "Mentor Mothers": COMMUNITY_MODELS_ALL,
    "Outreach Team Leader - OTL": COMMUNITY_MODELS_ALL,
    "Lay Counselors": COMMUNITY_MODELS_OUTREACH,
    "Linkage Officer": COMMUNITY_MODELS_OUTREACH,
    "Personal Care Workers": COMMUNITY_MODELS_OUTREACH,
    "Social Work and related professionals": COMMUNITY_MODELS_OUTREACH,
    "Youth workers": COMMUNITY_MODELS_OUTREACH,
    "WBOT OTL": None,
    "WBOT CHW": None,
}

# Source sheet name to indicator name.
SOURCE_INDICATORS = {
    "PrEP_New": "PrEP_NEW",
    "TB PREV_D": "TB_PREV_D",
    "TB PREV_N": "TB_PREV_N",
    "TB_STAT_Denom": "TB_STAT_D",
    "TB_STAT_Numer": "TB_STAT_N",
    "TX TB_D": "TX_TB_D",
    "TX TB_N": "TX_TB_N",
    "TX_PVLS_Denom": "TX_PVLS_D",
    "TX_PVLS_Numer": "TX_PVLS_N",
}
# Indicator with numerator/denominator suffix to plain name.
PLAIN_INDICATORS = {
    "TB_PREV_D": "TB_PREV",
    "TB_PREV_N": "TB_PREV",
    "TB_STAT_N": "TB_STAT",
    "TB_STAT_D": "TB_STAT",
    "TX_PVLS_D": "TX_PVLS",
    "TX_PVLS_N": "TX_PVLS",
    "TX_TB_N": "TX_TB",
    "TX_TB_D": "TX_TB",
    "TX_TB_Pos_D": "TX_TB",
    "TX_TB_TestType_D": "TX_TB",
}

# Fine age bands folded into 50+.
OVER_FIFTY = {
    "50-54": "50+",
    "55-59": "50+",
    "60-64": "50+",
    "65+": "50+",
}

# Age-band spellings of the private-sector and cash sources.
AGE_BAND_SPELLINGS = {
    "Less than one year": "<01",
    "1-4": "01-04",
    "5-9": "05-09",
    "65-69": "65+",
    "70-74": "65+",
    "75-79": "65+",
    "80-84": "65+",
    "85 +": "65+",
}

# Age bands of the cash source that are no plain range.
CASH_AGE_SPELLINGS = {"25 and older": "25+", "0 to 14": "0-14", "< 5": "<5", "> 80": "80+", "Other": "Unknown Age"}

# Ordered patterns that settle district spellings.
DISTRICT_PATTERNS = (
    ("OR Tambo", "Oliver Tambo District Municipality"),
    ("Thabo", "Thabo Mofutsanyane District Municipality"),
    ("khanya", "Umkhanyakude District Municipality"),
    ("zinyathi", "Umzinyathi District Municipality"),
    ("ukela", "Uthukela District Municipality"),
    ("Mgcawu", "Zwelentlanga Fatman Mgcawu District Municipality"),
)

# Staffing category uid by cadre pattern, first match wins.
STAFF_CATEGORIES = (
    ("Clin", "mkOfrTuz7tS"),
    ("Lab", "T1jZtIrfVkq"),
    ("Lay", "a9N5X73zhET"),
    ("Mana", "oaRfTQD4RLG"),
    ("Other", "wKH5X6oHquw"),
    ("Pharm", "VYMJrOJU5rQ"),
)
STAFF_CATEGORY_DEFAULT = "itxIkeWqiE9"

# Texts of the checks, as they stand in the reports.
RULE_TEXTS = {
    "ovc_exit_share": "OVC Serv exited without GRAD / OVC_SERV> 10%",
    "ovc_hivstat": "OVC_HIVSTAT not equal to OVC_SERV <18",
    "prep_ct_keypop": "PrEP_CT<PrEP_CT KeyPop Disagg",
    "prep_ct_result": "PrEP_CT<PrEP_CT TestResult Disagg",
    "index_offered": "Index_offered<Index_accepted",
    "index_contacts": "Index_contacts <contacts_ new_pos + contacts_ new_neg + contacts_ known_pos",
    "positives_recent": "HTS_TST_POS (>=15) < HTS_RECENT",
    "hts_positives": "HTS_TST < HTS_TST_POS",
    "prep_new": "PrEP_NEW > PrEP_CT",
    "tx_new": "TX_NEW > TX_CURR",
    "tx_rtt": "TX_RTT > TX_CURR",
    "tx_dispensed": "TX_CURR > SC_CURR",
    "tb_prev": "TB_PREV_D < TB_PREV_N",
    "tb_stat": "TB_STAT_N >  TB_STAT_D",
    "tx_pvls": "TX_PVLS_N >  TX_PVLS_D",
    "pmtct_stat": "PMTCT_STAT_N >  PMTCT_STAT_D",
    "hei_pos": "PMTCT_HEI_POS > PMTCT_EID",
    "eid_positives": "PMTCT_EID 0-2months > PMTCT_STAT_POS+HTS_TST_POS_PMTCT",
    "stat_art": "PMTCT_STAT_POS < PMTCT_ART",
    "iit_short": "TX ML IIT <3 > IIT 3+",
}
