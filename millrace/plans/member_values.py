"""Fixed values of the member audit: plan and attribute codes, code lists, building addresses, placeholders."""

OPT_IN_PLAN = "QMXBP7971"
OPT_OUT_PLAN = "QMXBP7938"
PLANS = [OPT_IN_PLAN, OPT_OUT_PLAN]
MEDICARE_PLAN = "QMXBP8050"
EXCLUDED_RATE = "IC00099"
RESTRICTED_ATTRIBUTE = "C10163853"
HEALTH_HOME_ATTRIBUTE = "C04423551"
ENGAGEMENT_CONCEPTS = ["502476", "502474"]

CASE_TYPES = [
    ("1", "Asthma"), ("2", "Behavioral Health"), ("3", "CAD"), ("4", "Chemical Dependency"), ("5", "CHF"), ("6", "COPD"),
    ("7", "Diabetes"), ("8", "ED Management"), ("9", "ESRD/Renal"), ("10", "Gastrointestinal"), ("11", "Genetic Anomalies"),
    ("12", "Hematology/Oncology"), ("13", "Immunological/Infectious Disease"), ("14", "Long Term Care"), ("15", "Maternity"),
    ("16", "Maternity - High Risk"), ("17", "Medication Therapy Management Program"), ("18", "Medical Disability"),
    ("19", "Neonatal"), ("20", "Neurological"), ("21", "Pain Management"), ("22", "Pediatrics"), ("23", "Transplant"),
    ("24", "Trauma/Wound"), ("25", "Other"), ("26", "Hypertension"), ("27", "HIV/AIDS"), ("28", "Sickle Cell"),
    ("29", "Hepatitis C"), ("30", "IDD"), ("31", "Smoking Cessation"), ("32", "Weight Management"),
]
BEHAVIORAL = ["2", "4"]
MATERNITY = ["15", "16", "22", "19"]
# every case type that is neither behavioral nor maternity is a chronic condition
CHRONIC = [(code, name) for code, name in CASE_TYPES if code not in BEHAVIORAL + MATERNITY]
STREAM_LABELS = [
    ("1", "Women of Reproductive age"), ("2", "Behavioral Health"), ("3", "Chronic Conditions"), ("4", "Healthy Adult"),
]

# Street patterns of each building; the first building that matches either address line counts. The rule in
# the middle looks at the first address line and the city.
BUILDINGS = [
    ("%5225%Cherry%Creek%PK%", "Cherry Blossom"),
    ("%4770%Tamarack%Blvd%", "Restoration Plaza III"),
    ("%5861%Roche%Dr%", "Worthington Place"),
    ("%140%Imperial%Dr%", "Stygler Village"),
    (["%4800%Tamarack%Blvd%", "%4750%Tamarack%Blvd%"], "Restoration Plaza I & II"),
    (["%814%Hartford%St%", "%814%Stafford%Av%"], "Stafford Village"),
]
CITY_BUILDING = ("%165%N%STYGLER%RD%", "%gahanna%", "Stygler Commons(AL)")
BUILDINGS_AFTER_CITY = [
    ("%3623%heritage%club%dr%", "Woodview Ct"),
    ("%4105%Stoneridge%ln%", "Stoneridge Ct"),
    ("%211%N%Champion%Ave%", "Poindexter Place"),
    ("%771%Chestnut%Grove%Dr%", "Chestnut House"),
    ("%7500%Tussing%rd%", "Grand Haven Commons"),
    ("%3400%Vision%center%ct%", "Argus Ct"),
    ("%1620%Lonsdal%Rd%", "Castleton Gardens"),
    ("%338%W%Main%St%", "Meadowview Village"),
    ("%2346%Sonora%Dr%", "Melanie Manor"),
    ("%3750%Sturbridge%Ct%", "Sturbridge Green"),
]

SENTINEL = "2078-12-31"
_TIMES = [
    "memberdeceased", "mmpmembermoved", "mcpenrollmentdate", "mcptermdate", "retroenrolledaftereffdate",
    "mostrecenttermpriortoenrollmentgap", "waivereffdate", "firstwsp/pcspmilestonecreate", "programenrollmenthra",
    "hrainprogressincca", "behavioralhealthhra", "erphra", "phq9hra", "icthra", "cagehra", "asamhra",
    "nextschedulef2fvisit", "mostrecentsuccessfulf2f", "nextf2fdue", "ccacareplancreatedate", "initialassessment",
    "mostrecentassessment", "healthstatusassessmentdate", "dateoftelephoniccontactsuccessful",
    "dateoftelephoniccallunsuccessful", "dateoftelephonicrefusal", "nexttelephoniccontactdue", "dateofmemberconsent",
    "sf12date", "sf12duedate", "mostrecentoptindate", "redeterminationdate(834)", "programenrollcompleteddate",
    "cdsmpcompleteddate",
]
_BLANKS = [
    "secondarycm", "thirdcm", "enrollmentstatus", "membertype", "waivertype", "mostrecentf2fregistrar cca",
    "initialcdpsstrat", "firstassessmenttype", "mostrecentassessmenttype", "externalid", "ncr", "ccastratification",
]
PLACEHOLDERS = {
    **{name: (SENTINEL, "timestamp") for name in _TIMES},
    **{name: (" ", "string") for name in _BLANKS},
    "stratificationmismatch": ("", "string"),
    "healthhomemember": ("", "string"),
    "medicareid": (None, "string"),
    "daysleftuntilinitialassessmentdue": (0, "int"),
    "daysleftuntilreassessmentdue": (0, "int"),
    "newpopindicator": (0, "int"),
    "restricted": (0, "int"),
    "nf days": (None, "int"),
    "patient liability": ("0.00", "decimal(10,2)"),
    "patient liablity effective": (SENTINEL, "date"),
    "restricted effective date": (SENTINEL, "date"),
    "restricted term date": (SENTINEL, "date"),
}
