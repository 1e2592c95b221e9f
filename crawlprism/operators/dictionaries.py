"""Word lists and patterns, as plain data.

Everything between the "fixed values" comments has to equal the published lists
for results to agree, including misspelt entries; corrected spellings are kept
apart at the end and are off by default.
"""

from __future__ import annotations

# --- fixed values: keyword lists -------------------------------------------------

PRODUCT_KEYWORDS = [
    "u.s. census bureau",
    "us census bureau",
    "uscb",
    "census bureau",
    "census.gov",
    "data.census.gov",
    "factfinder.census.gov",
    "american community survey",
]

GEOGRAPHIC_KEYWORDS = [
    "zip code", "zip codes", "census tract", "block group", "county", "state",
    "metropolitan area", "city", "radius", "geographic area", "location",
]

SOCIAL_KEYWORDS = [
    "ancestry", "citizen voting-age population", "citizenship status", "disability status",
    "educational attainment", "fertility", "grandparets as caregivers", "language spoken at home",
    "marital history", "marital status", "migration residence 1 year ago", "place of birth",
    "school enrollment", "undergraduate field of degree", "veterans status",
    "period of military service", "year of entry",
]

ECONOMIC_KEYWORDS = [
    "class of worker", "commuting and place of work", "employment status", "food stamps",
    "supplemental nutrition assistance program", "health insurance coverage", "income and earnings",
    "industry", "occupation", "poverty status", "work status last year",
]

HOUSING_KEYWORDS = [
    "bedrooms", "computer & internet use", "house heating fuel", "kitchen facilities",
    "occupancy/vacancy status", "occupants per room", "rent", "rooms", "selected monthly owner costs",
    "telephone service available", "tenure (owner/renter)", "units in structure", "value of home",
    "vehicles available", "year householder moved in unit", "year structure built",
]

DEMOGRAPHIC_KEYWORDS = [
    "age; sex", "group quarters population", "hispanic or latino origin", "race",
    "relationship to householder", "total population",
]

SUBJECT_KEYWORDS = SOCIAL_KEYWORDS + ECONOMIC_KEYWORDS + HOUSING_KEYWORDS + DEMOGRAPHIC_KEYWORDS

KEYWORD_LISTS = {
    "product": PRODUCT_KEYWORDS,
    "geographic": GEOGRAPHIC_KEYWORDS,
    "subject": SUBJECT_KEYWORDS,
}

# --- fixed values: signals over normalised text ------------------------------------

CENSUS_SIGNALS = {
    # publisher
    "census_bureau": r"\b(u\.?\s*s\.?\s*)?census\s*bureau\b",
    "us_census": r"\bu\.?\s*s\.?\s*census\b",
    "census_generic": r"\b(the\s+)?census(?!\s*of\s*agriculture)\b",
    "census_gov_domain": r"\b(census\.gov|data\.census\.gov|api\.census\.gov|factfinder\.census\.gov)\b",
    # decennial programme
    "decennial_census": r"\b(decennial\s+census|census\s+20\d{2}|population\s+and\s+housing\s+census)\b",
    "sf_summary_files": r"\b(summary\s+file\s*(?:1|2)|sf(?:1|2)\b)",
    "redistricting_pl94": r"\b(p\.?l\.?\s*94[-–]171|redistricting\s+data)\b",
    "pums": r"\b(public\s+use\s+microdata\s+sample|pums)\b",
    "short_long_form": r"\b(short\s+form|long\s+form)\b",
    # economic programmes
    "economic_census": r"\beconomic\s+census\b",
    "census_of_govts": r"\bcensus\s+of\s+governments\b",
    "cbp": r"\b(county\s+business\s+patterns|cbp)\b",
    "bds": r"\b(business\s+dynamics\s+statistics|bds)\b",
    "lbd": r"\b(longitudinal\s+business\s+database|lbd)\b",
    "qwi_led_onthemap": r"\b(qwi|lehd|lodes|on\s*the\s*map|onthemap)\b",
    # household surveys
    "cps": r"\b(current\s+population\s+survey|cps)\b",
    "sipp": r"\b(survey\s+of\s+income\s+and\s+program\s+participation|sipp)\b",
    "ahs": r"\b(american\s+housing\s+survey|ahs)\b",
    # geography
    "tiger_line": r"\b(tiger(?:/line)?\s*(?:shapefiles?)?|tiger/line|tigerline)\b",
    "gazetteer": r"\bgazetteer\b",
    "fips": r"\bfips\s*(?:codes?)?\b",
    "tract_block_group": r"\b(census\s*tracts?|block\s*groups?|census\s*blocks?)\b",
    "places_counties_mcd": r"\b(incorporated\s*places?|counties|minor\s*civil\s*divisions?|mcds?)\b",
    "puma": r"\b(puma|public\s+use\s+microdata\s+area[s]?)\b",
    # portals
    "data_portals": r"\b(data\.census\.gov|api\.census\.gov|factfinder|american\s+factfinder)\b",
    "microdata_api": r"\b(microdata\s*api|pums\s*api)\b",
    # credit lines
    "attribution_1": r"(source\s*:\s*(?:the\s+)?u\.?\s*s\.?\s*census\s*bureau)",
    "attribution_2": r"(according\s+to\s+(?:the\s+)?u\.?\s*s\.?\s*census\s*bureau)",
    "attribution_3": r"(from\s+(?:the\s+)?u\.?\s*s\.?\s*census\s*bureau)",
}

ATTRIBUTION_SIGNALS = ("attribution_1", "attribution_2", "attribution_3")
DOMAIN_SIGNALS = ("census_gov_domain", "data_portals", "microdata_api")
REPACKAGE_DENSITY = 0.12
MIN_TEXT_LENGTH = 100

# --- fixed values: survey patterns over raw text -----------------------------------

_CITE = r"(source|according\s+to|data\s+from|using(?:\s+the)?\s+data\s+from|as\s+reported\s+by|via|cites?)"
_TOPIC = r"(census|american\s+community\s+survey|ACS|S\d{4}|DP0?\d{2,3}|CP0?\d{2,3}|[BC]\d{5})"

ACS_SIGNALS = {
    "acs_phrase": r"(?i)\bamerican\s+community\s+survey\b|\bACS\b(?!\w)",
    "acs_links": r"(?i)\b(?:https?://)?(?:www\.)?(?:data\.)?census\.gov\S*|\bwww2\.census\.gov\S*|\bapi\.census\.gov\S*",
    "acs_subject_tables": r"(?i)\bS\d{4}(?:PR)?\b|\bDP0?\d{2,3}\b|\bCP0?\d{2,3}\b",
    "acs_detail_tables": r"(?i)\b[BC]\d{5}(?:PR)?(?:[A-Z]{1,3}|_?MOE)?\b",
    "acs_table_word": (
        r"(?i)\btable(?:s)?\s*(?:S\d{4}(?:PR)?|DP0?\d{2,3}|CP0?\d{2,3}|[BC]\d{5}(?:PR)?(?:[A-Z]{1,3}|_?MOE)?)\b"
    ),
    "acs_near_moe": r"(?i)\b(MOE|margin\s+of\s+error)\b",
    "acs_cite_verbs": (
        r"(?i)\b(source|according\s+to|data\s+from|using(?:\s+the)?\s+data\s+from"
        r"|as\s+reported\s+by|via|cites?|cite[d]?\s+by)\b"
    ),
    "acs_geo": (
        r"(?i)\b(PUMA|ZCTA|tracts?|block\s+groups?|county\s+subdivisions?|place code|CBSA|MSA|county"
        r"|parish|borough|census\s+tract|state|place)\b"
    ),
    "acs_tools": (
        r"(?i)\b(my\s+congressional\s+district|my\s+tribal\s+area|census\s+business\s+builder"
        r"|narrative\s+profiles?|data\s+profiles?|comparison\s+profiles?)\b"
    ),
    "acs_tiger_pums": r"(?i)\bTIGER/Line\b|\bPUMS\b|\bpublic\s+use\s+microdata\b",
    "acs_near_table": rf"(?is){_CITE}.{{0,250}}{_TOPIC}|{_TOPIC}.{{0,250}}{_CITE}",
}

# --- fixed values: survey product names and subject table identifiers --------------

ACS_PRODUCT_NAMES = [
    "American Community Survey", "ACS", "My Congressional District", "My Tribal Area",
    "OnTheMao for Emergency Management", "Census Business Builder", "Narrative Profiles",
    "Data Profiles", "Comparison Profiles",
    " TIGER/Line Shapefiles with Selected Demographic and Economic Data",
    "ACS Public Use Microdata Sample",
]

ACS_TABLE_IDS = (
    "S0101 S0102 S0102PR S0103 S0103PR S0501 S0502 S0502PR S0503 S0504 S0505 S0506 S0601 S0601PR "
    "S0701 S0701PR S0702 S0801 S0801PR S0802 S0804 S0902 S1001 S1002 S1101 S1201 S1251 S1301 S1401 "
    "S1501 S1502 S1601 S1602 S1603 S1701 S1702 S1703 S1810 S1811 S1901 S1902 S1903 S2001 S2002 S2101 "
    "S2201 2301 S2302 S2303 S2401 S2402 S2403 S2404 S2405 S2406 S2407 S2408 S2409 S2410 S2411 S2412 "
    "S2413 S2414 S2418 S2419 S2501 S2502 S2503 S2504 S2505 S2506 S2507 S2601A S2601C S2601CPR S2602 "
    "S2603 S2701 S2702 S2702PR S2703 S2704 S2802 S2901 S2713 S2601B"
).split()

# --- fixed values: language and stop words -----------------------------------------

ENGLISH_COMMON_WORDS = (
    "the be to of and a in that have i it for not on with he as you do at this but his by from they "
    "we say her she or an will my one all would there their what so up out if about who get which go "
    "me when make can like time no just him know take people into year your good some could them see "
    "other than then now look only come its over think also back after use two how our work first "
    "well way even new want because any these give day most us"
).split()

# Spark ML's English default list.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she "
    "her hers herself it its itself they them their theirs themselves what which who whom this that "
    "these those am is are was were be been being have has had having do does did doing a an the and "
    "but if or because as until while of at by for with about against between into through during "
    "before after above below to from up down in out on off over under again further then once here "
    "there when where why how all any both each few more most other some such no nor not only own same "
    "so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd "
    "you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've "
    "isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't "
    "shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's "
    "when's where's who's why's would"
).split()

# Web tokens, then every number below 1000 as written by str().
WEB_STOP_WORDS = ["www", "http", "com", "org", "gov", "edu", "000", "00"] + [
    str(n) for n in range(1000)
]

SITES_OF_INTEREST = ["urbaninstitute.org", "pewresearch.org"]

# --- end of fixed values -----------------------------------------------------------

# Literals of which every match contains at least one. A byte search for them is far
# cheaper than a regex, so they are tested first. For CENSUS_SIGNALS they are
# searched in normalised text, where a whitespace run is one space; for ACS_SIGNALS
# in lower-cased text, so they hold no spaces.
CENSUS_HINTS = {
    "census_bureau": ("census",),
    "us_census": ("census",),
    "census_generic": ("census",),
    "census_gov_domain": ("census.gov",),
    "decennial_census": ("census",),
    "sf_summary_files": ("summary file", "sf1", "sf2"),
    "redistricting_pl94": ("171", "redistricting data"),
    "pums": ("public use microdata", "pums"),
    "short_long_form": ("short form", "long form"),
    "economic_census": ("census",),
    "census_of_govts": ("census",),
    "cbp": ("county business", "cbp"),
    "bds": ("business dynamics", "bds"),
    "lbd": ("longitudinal business", "lbd"),
    "qwi_led_onthemap": ("qwi", "lehd", "lodes", "the map", "themap"),
    "cps": ("current population", "cps"),
    "sipp": ("survey of income", "sipp"),
    "ahs": ("american housing", "ahs"),
    "tiger_line": ("tiger",),
    "gazetteer": ("gazetteer",),
    "fips": ("fips",),
    "tract_block_group": ("tract", "block"),
    "places_counties_mcd": ("incorporated", "counties", "minor", "mcd"),
    "puma": ("puma", "public use microdata"),
    "data_portals": ("census.gov", "factfinder"),
    "microdata_api": ("microdata", "pums"),
    "attribution_1": ("census",),
    "attribution_2": ("census",),
    "attribution_3": ("census",),
}

ACS_HINTS = {
    "acs_phrase": ("american", "acs"),
    "acs_links": ("census.gov",),
    "acs_table_word": ("table",),
    "acs_near_moe": ("moe", "margin"),
    "acs_cite_verbs": ("source", "according", "data", "reported", "via", "cite"),
    "acs_geo": (
        "puma", "zcta", "tract", "block", "county", "place", "cbsa", "msa", "parish", "borough", "state",
    ),
    "acs_tools": ("congressional", "tribal", "builder", "profile"),
    "acs_tiger_pums": ("tiger", "pums", "microdata"),
    "acs_near_table": ("source", "according", "data", "reported", "via", "cite"),
}

CORRECTED_KEYWORDS = {"grandparets as caregivers": "grandparents as caregivers"}
CORRECTED_ACS_NAMES = {
    "OnTheMao for Emergency Management": "OnTheMap for Emergency Management",
    " TIGER/Line Shapefiles with Selected Demographic and Economic Data":
        "TIGER/Line Shapefiles with Selected Demographic and Economic Data",
}
CORRECTED_TABLE_IDS = {"2301": "S2301"}
