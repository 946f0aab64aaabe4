"""Column lists, declared widths and code lists of the two published feeds.

Everything between the FIXED VALUES markers is data that has to agree with the
published layouts for results to be right; the rest derives from it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- FIXED VALUES -----------------------------------------------------------
# Registration snapshot, current layout: name and declared width.
REGISTRATION_LAYOUT = """
county_id                int
county_desc              15
voter_reg_num            12
ncid                     12
last_name                25
first_name               20
middle_name              20
name_suffix_lbl          3
status_cd                2
voter_status_desc        25
reason_cd                2
voter_status_reason_desc 60
res_street_address       65
res_city_desc            60
state_cd                 2
zip_code                 9
mail_addr1               40
mail_addr2               40
mail_addr3               40
mail_addr4               40
mail_city                30
mail_state               2
mail_zipcode             9
full_phone_number        12
confidential_ind         1
registr_dt               10
race_code                3
ethnic_code              3
party_cd                 3
gender_code              1
birth_year               4
age_at_year_end          3
birth_state              2
drivers_lic              1
precinct_abbrv           6
precinct_desc            60
municipality_abbrv       6
municipality_desc        60
ward_abbrv               6
ward_desc                60
cong_dist_abbrv          6
super_court_abbrv        6
judic_dist_abbrv         6
nc_senate_abbrv          6
nc_house_abbrv           6
county_commiss_abbrv     6
county_commiss_desc      60
township_abbrv           6
township_desc            60
school_dist_abbrv        6
school_dist_desc         60
fire_dist_abbrv          6
fire_dist_desc           60
water_dist_abbrv         6
water_dist_desc          60
sewer_dist_abbrv         6
sewer_dist_desc          60
sanit_dist_abbrv         6
sanit_dist_desc          60
rescue_dist_abbrv        6
rescue_dist_desc         60
munic_dist_abbrv         6
munic_dist_desc          60
dist_1_abbrv             6
dist_1_desc              60
vtd_abbrv                6
vtd_desc                 60
"""

# Registration snapshot, previous layout (valid until 2022-02-05): names in file order.
PREVIOUS_REGISTRATION_LAYOUT = """
county_id county_desc voter_reg_num status_cd voter_status_desc reason_cd
voter_status_reason_desc absent_ind name_prefx_cd last_name first_name middle_name
name_suffix_lbl res_street_address res_city_desc state_cd zip_code mail_addr1
mail_addr2 mail_addr3 mail_addr4 mail_city mail_state mail_zipcode
full_phone_number race_code ethnic_code party_cd gender_code birth_age birth_state
drivers_lic registr_dt precinct_abbrv precinct_desc municipality_abbrv
municipality_desc ward_abbrv ward_desc cong_dist_abbrv super_court_abbrv
judic_dist_abbrv nc_senate_abbrv nc_house_abbrv county_commiss_abbrv
county_commiss_desc township_abbrv township_desc school_dist_abbrv
school_dist_desc fire_dist_abbrv fire_dist_desc water_dist_abbrv water_dist_desc
sewer_dist_abbrv sewer_dist_desc sanit_dist_abbrv sanit_dist_desc
rescue_dist_abbrv rescue_dist_desc munic_dist_abbrv munic_dist_desc dist_1_abbrv
dist_1_desc dist_2_abbrv dist_2_desc confidential_ind birth_year ncid vtd_abbrv
vtd_desc
"""

# Columns the previous layout declares as not used.
PREVIOUS_UNUSED = ("absent_ind", "name_prefx_cd", "dist_2_abbrv", "dist_2_desc")
# Renames from the previous to the current layout.
PREVIOUS_RENAMES = {"birth_age": "age_at_year_end"}

# Participation snapshot: name and declared width.
PARTICIPATION_LAYOUT = """
county_id         int
county_desc       20
voter_reg_num     12
election_lbl      10
election_desc     230
voting_method     10
voted_party_cd    3
voted_party_desc  60
pct_label         6
pct_description   60
ncid              12
voted_county_id   3
voted_county_desc 60
vtd_label         6
vtd_description   60
"""

STATUS_CODES = {
    "A": "ACTIVE",
    "D": "DENIED",
    "I": "INACTIVE",
    "R": "REMOVED",
    "S": "TEMPORARY (APPLICABLE TO MILITARY AND OVERSEAS)",
}
RACE_CODES = {
    "A": "ASIAN",
    "B": "BLACK or AFRICAN AMERICAN",
    "I": "AMERICAN INDIAN or ALASKA NATIVE",
    "M": "TWO or MORE RACES",
    "O": "OTHER",
    "P": "NATIVE HAWAIIAN or PACIFIC ISLANDER",
    "U": "UNDESIGNATED",
    "W": "WHITE",
}
ETHNICITY_CODES = {
    "HL": "HISPANIC or LATINO",
    "NL": "NOT HISPANIC or NOT LATINO",
    "UN": "UNDESIGNATED",
}
# County names in the order of their identification numbers 1..99; the last one is "00".
COUNTY_NAMES = """
ALAMANCE ALEXANDER ALLEGHANY ANSON ASHE AVERY BEAUFORT BERTIE BLADEN BRUNSWICK
BUNCOMBE BURKE CABARRUS CALDWELL CAMDEN CARTERET CASWELL CATAWBA CHATHAM CHEROKEE
CHOWAN CLAY CLEVELAND COLUMBUS CRAVEN CUMBERLAND CURRITUCK DARE DAVIDSON DAVIE
DUPLIN DURHAM EDGECOMBE FORSYTH FRANKLIN GASTON GATES GRAHAM GRANVILLE GREENE
GUILFORD HALIFAX HARNETT HAYWOOD HENDERSON HERTFORD HOKE HYDE IREDELL JACKSON
JOHNSTON JONES LEE LENOIR LINCOLN MACON MADISON MARTIN MCDOWELL MECKLENBURG
MITCHELL MONTGOMERY MOORE NASH NEWHANOVER NORTHAMPTON ONSLOW ORANGE PAMLICO
PASQUOTANK PENDER PERQUIMANS PERSON PITT POLK RANDOLPH RICHMOND ROBESON
ROCKINGHAM ROWAN RUTHERFORD SAMPSON SCOTLAND STANLY STOKES SURRY SWAIN
TRANSYLVANIA TYRRELL UNION VANCE WAKE WARREN WASHINGTON WATAUGA WAYNE WILKES
WILSON YADKIN YANCEY
"""
LAST_COUNTY_ID = "00"

# Literal found in place of a registration date.
PLACEHOLDER_DATE = "##/##/####"
# Integer columns of the registration table; date columns of the participation table.
REGISTRATION_INT_COLUMNS = ("birth_year", "age_at_year_end")
PARTICIPATION_DATE_COLUMNS = ("election_lbl",)
# --- END OF FIXED VALUES ----------------------------------------------------

KEY = "ncid"
SNAPSHOT_DATE = "data_date"
ELECTION_DATE = "election_lbl"


def _pairs(layout: str) -> list[tuple[str, str]]:
    return [tuple(line.split()) for line in layout.strip().splitlines()]


def _widths(layout: str) -> dict[str, int]:
    return {name: int(width) for name, width in _pairs(layout) if width != "int"}


REGISTRATION_COLUMNS = [name for name, _ in _pairs(REGISTRATION_LAYOUT)]
PREVIOUS_REGISTRATION_COLUMNS = PREVIOUS_REGISTRATION_LAYOUT.split()
PARTICIPATION_COLUMNS = [name for name, _ in _pairs(PARTICIPATION_LAYOUT)]

REGISTRATION_WIDTHS = _widths(REGISTRATION_LAYOUT)
PARTICIPATION_WIDTHS = _widths(PARTICIPATION_LAYOUT)

COUNTY_CODES = {
    **{str(i): name for i, name in enumerate(COUNTY_NAMES.split()[:-1], start=1)},
    LAST_COUNTY_ID: COUNTY_NAMES.split()[-1],
}

# X_abbrv / X_desc pairs: a code and the description it stands for.
CODE_PAIRS = [
    (c, c.removesuffix("_abbrv") + "_desc")
    for c in REGISTRATION_COLUMNS
    if c.endswith("_abbrv") and c.removesuffix("_abbrv") + "_desc" in REGISTRATION_COLUMNS
]

PARTY_COLUMNS = ["party_cd"]
ADDRESS_COLUMNS = [
    c for c in REGISTRATION_COLUMNS
    if c.startswith(("res_", "mail_")) or c in ("state_cd", "zip_code")
]


def _text_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _typed(name: str, overrides: dict[str, T.DataType]) -> T.StructField:
    return T.StructField(name, overrides.get(name, T.StringType()))


REGISTRATION_TABLE = T.StructType(
    [T.StructField(SNAPSHOT_DATE, T.DateType())]
    + [_typed(c, {i: T.IntegerType() for i in REGISTRATION_INT_COLUMNS}) for c in REGISTRATION_COLUMNS]
)
PARTICIPATION_TABLE = T.StructType(
    [_typed(c, {d: T.DateType() for d in PARTICIPATION_DATE_COLUMNS}) for c in PARTICIPATION_COLUMNS]
)
# The stored participation log additionally carries the date of the snapshot that brought a row.
PARTICIPATION_LOG = T.StructType(
    PARTICIPATION_TABLE.fields + [T.StructField(SNAPSHOT_DATE, T.DateType())]
)

REGISTRATION_FILE = _text_schema(REGISTRATION_COLUMNS)
PARTICIPATION_FILE = _text_schema(PARTICIPATION_COLUMNS)

LEDGER = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("processed", T.BooleanType()),
    T.StructField("archived", T.BooleanType()),
])
