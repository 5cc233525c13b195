"""Member audit on the test tables: orders are enrolments and cases, line items are coverages, customers are members."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import first_match
from ..operators.rows import effective_at
from ..operators.spans import continuous_start, span_gaps, term_before_gap
from ..plans import members as plan
from ..plans.report_loads import load_member_report
from ..sources.staging import stage
from ..sources.tables import table
from .common import day_text, job_input, load, text

AS_OF = date(1999, 6, 1)
NOW = datetime(1999, 6, 1, 8)


def _days(col, n):
    return F.date_add(col.cast("date"), n.cast("int"))


def _pick(col, mapping: dict, default=None):
    return first_match([(F.col(col) == k, v if not isinstance(v, str) else F.lit(v)) for k, v in mapping.items()], default)


PLANS = {"1-URGENT": "QMXBP7971", "2-HIGH": "QMXBP7971", "3-MEDIUM": "QMXBP7938", "4-NOT SPECIFIED": "QMXBP7938"}


@job_input(dealt=True)
def enrol_keys(spark: SparkSession, folder: str) -> DataFrame:
    od = load(spark, folder, "orders").repartition(spark.sparkContext.defaultParallelism)
    start = F.col("o_orderdate").cast("date")
    return od.select(
        F.concat(F.lit("e"), text("o_orderkey")).alias("enrollid"), text("o_custkey").alias("memid"),
        _pick("o_orderpriority", PLANS, F.lit("QMXBP8050")).alias("planid"), _pick("o_orderstatus", {"F": "A1", "O": "B1"}, F.lit("H1")).alias("ratecode"),
        F.concat(F.lit("C"), text("o_custkey")).alias("carriermemid"),
        F.when(F.col("o_totalprice") > 450000, "EXT").when(F.col("o_orderstatus") == "F", "int").otherwise("INT").alias("segtype"),
        start.alias("effdate"), _days(start, F.floor(F.col("o_totalprice") / 1000)).alias("termdate"), start.alias("lastupdate"),
        _days(start, 5 - F.floor(F.col("o_totalprice") / 50000)).alias("createdate"))


@job_input(dealt=True)
def enrol_coverage(spark: SparkSession, folder: str) -> DataFrame:
    li = load(spark, folder, "lineitem").repartition(spark.sparkContext.defaultParallelism)
    ship = F.col("l_shipdate").cast("date")
    return li.select(
        F.concat(F.lit("e"), text("l_orderkey")).alias("enrollid"), _pick("l_returnflag", {"A": "A1", "N": "B1"}, F.lit("H2")).alias("ratecode"),
        F.concat(F.lit("cc"), text("l_linenumber")).alias("coveragecodeid"), ship.alias("effdate"),
        _days(ship, F.col("l_quantity") * 10).alias("termdate"))


@job_input
def people(spark: SparkSession, folder: str) -> DataFrame:
    cust = load(spark, folder, "customer")
    woman = F.col("c_mktsegment").isin("BUILDING", "FURNITURE")
    return cust.select(
        text("c_custkey").alias("memid"), F.concat(F.lit("n"), text("c_custkey")).alias("entityid"), _born().alias("dob"),
        F.when(woman, "F").otherwise("M").alias("sex"), F.col("c_name").alias("fullname"), F.concat(F.lit("l"), text("c_nationkey")).alias("primarylanguage"))


@job_input
def entities(spark: SparkSession, folder: str) -> DataFrame:
    cust = load(spark, folder, "customer")
    street = {"BUILDING": "5225 Cherry Creek Pk S", "MACHINERY": "165 n stygler rd apt 2", "FURNITURE": "4770 TAMARACK blvd"}
    return cust.select(
        F.concat(F.lit("n"), text("c_custkey")).alias("entid"), F.concat(F.col("c_mktsegment"), F.lit("  ")).alias("lastname"),
        F.col("c_name").alias("firstname"), F.when(F.col("c_acctbal") < -500, "Other").otherwise("Member").alias("enttype"),
        F.lit(date(2078, 12, 31)).alias("termdate"), _pick("c_mktsegment", street, F.col("c_name")).alias("addr1"),
        F.when(F.col("c_nationkey") < 12, "Gahanna").otherwise("Town").alias("city"), F.lit("po box").alias("phyaddr1"), F.lit("").alias("phyaddr2"),
        F.lit("City").alias("phycity"), F.lit("County").alias("phycounty"), text("c_nationkey").alias("phyzip"), F.lit("555").alias("phone"))


def enrolment(spark: SparkSession, folder: str) -> plan.Enrolment:
    return plan.Enrolment(*[f(spark, folder) for f in (enrol_keys, enrol_coverage, people, entities)])


def _born():
    return _days(F.lit(date(1944, 1, 1)), F.col("c_acctbal") * 2)


def code_lists(spark: SparkSession, folder: str) -> DataFrame:
    ids = F.array(*[F.lit(i) for i in ("18", "17", "101", "502476", "502474")])
    return load(spark, folder, "nation").withColumn("id", F.explode(ids)).select(
        "id", text("n_nationkey").alias("sub_id"), F.lit("50").alias("mg_id"), F.lit("9").alias("type_id"), F.lit("0").alias("inactive"),
        first_match([((F.col("id") == "17") & (F.col("n_nationkey") < 2), F.lit("LOW")), ((F.col("id") == "17") & (F.col("n_nationkey") == 2), F.lit("Catastrophic")),
                     ((F.col("id") == "101") & (F.col("n_nationkey") < 2), F.lit("Active")), ((F.col("id") == "101") & (F.col("n_nationkey") == 2), F.lit("Monitoring"))],
                    F.concat(F.col("id"), F.lit(":"), F.col("n_name"))).alias("string"))


def cases(spark: SparkSession, folder: str, active: DataFrame) -> DataFrame:
    cust, od, region = (load(spark, folder, t) for t in ("customer", "orders", "region"))
    mbr = cust.select(F.col("c_custkey").alias("cid"), F.concat(F.lit("C"), text("c_custkey"), F.lit("  ")).alias("medicaid_no"), _born().alias("date_of_birth"),
                      F.when(F.col("c_acctbal") < 0, "6").otherwise("5").alias("employer"), F.lit("x").alias("temp_cid_link"))
    patient = cust.select(F.concat(F.lit("p"), text("c_custkey")).alias("id"), F.col("c_custkey").alias("cid"))
    case = od.select(
        F.concat(F.lit("p"), text("o_custkey")).alias("patient_id"), _pick("o_orderstatus", {"F": "1", "O": "4"}, F.lit("2")).alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "General").otherwise(F.col("o_orderpriority")).alias("name"), F.lit("2").alias("type_id"),
        text(F.col("o_orderkey") % 25).alias("tzx_type"), text(F.col("o_orderkey") % 4).alias("acuity"), text(F.col("o_orderkey") % 3).alias("phase"),
        F.when(F.col("o_totalprice") < 480000, text(F.floor(F.col("o_totalprice") / 12000))).alias("vf_01"), F.col("o_orderkey").alias("tzix_id"),
        F.lit("dx").alias("diagnosis"), F.col("o_orderdate").cast("date").alias("open_date"), F.lit("c").alias("consent_type"),
        F.col("o_orderdate").cast("date").alias("consent_date"), F.col("o_orderdate").cast("date").alias("update_date"))
    status = region.select(text("r_regionkey").alias("id"), F.col("r_name").alias("status"))
    return plan.member_cases(active, mbr, patient, case, code_lists(spark, folder), status)


def _streams(spark: SparkSession, folder: str, active: DataFrame) -> DataFrame:
    category = load(spark, folder, "nation").filter(F.col("n_regionkey") > 1).select(
        F.col("n_nationkey").alias("category_id"), F.when(F.col("n_regionkey") == 3, "Other").otherwise(F.concat(F.lit("Cat"), F.col("n_name"))).alias("category_name"))
    return plan.case_streams(cases(spark, folder, active), category)


def member_active(spark: SparkSession, folder: str) -> DataFrame:
    dates = ("dob", "effdate", "termdate", "lastupdate")
    return plan.active_members(enrolment(spark, folder), AS_OF).withColumns({c: day_text(c) for c in dates}).withColumn("age", F.col("age").cast("int"))


def spans_in_force(spark: SparkSession, folder: str) -> DataFrame:
    """Enrolments in force on the day, with and without the demand that they last at least a day."""
    keys = enrolment(spark, folder).keys
    side = lambda strict: effective_at(keys, "effdate", "termdate", AS_OF, strict).groupBy("planid").agg(F.count("*").alias("n_rows")).withColumn("strict", F.lit(str(strict)))
    return side(True).unionByName(side(False))


def care_stream(spark: SparkSession, folder: str) -> DataFrame:
    active = plan.active_members(enrolment(spark, folder), AS_OF)
    out = _streams(spark, folder, active).withColumnRenamed("population stream", "stream")
    return out.select("membercid", "memname", "carriermemid", "memid", "lob", "org_patientid", "casetype", "acuity", "phase", "stream", "category_name",
                      "caseid", "name", "status", day_text("caseopendate").alias("caseopendate"), day_text("consent_date").alias("consent_date"),
                      day_text("lastupdated").alias("lastupdated"))


def engagement(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a user are engagement entries; each repeats for every case of the member."""
    streams = _streams(spark, folder, plan.active_members(enrolment(spark, folder), AS_OF))
    kind = F.when(F.col("event_type").isin("view", "click"), "502476").when(F.col("event_type") == "purchase", "502474").otherwise("1")
    ev = load(spark, folder, "events")
    said = ev.select(F.col("user_id").alias("cid"), kind.alias("concept_id"), F.get_json_object("props", "$.k").alias("str_value"), F.col("ts").alias("update_time"))
    concept = ev.select(kind.alias("id")).distinct()
    out = plan.engagement(streams, said, concept, code_lists(spark, folder))
    return out.select("carriermemid", "id", "memname", "cid", F.coalesce("engagementstatus", F.lit("")).alias("engagementstatus"),
                      day_text("update_time").alias("update_time"), "rnum")


def enrol_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as spans of their price in days: current stretch and last gap per customer."""
    keys = enrolment(spark, folder).keys
    gaps = span_gaps(keys, "memid", "effdate", "termdate", ["enrollid"], bucket=F.trunc("effdate", "month"))
    out = gaps.groupBy("memid").agg(
        F.count("*").alias("n_spans"), F.sum("restart").alias("restarts"), F.sum("enrollgap").alias("gaps"),
        F.coalesce(F.sum("gap"), F.lit(0)).alias("gap_days"), continuous_start("effdate").alias("firsteffdate"),
        term_before_gap("effdate", "termdate", ["enrollid"]).alias("firsttermdate"))
    return out.withColumns({c: day_text(c) for c in ("firsteffdate", "firsttermdate")})


def opt_transition(spark: SparkSession, folder: str) -> DataFrame:
    out = plan.opt_in_after_opt_out(enrolment(spark, folder).keys)
    return out.withColumn("latest_opt_in", day_text("latest_opt_in"))


def _overlaid(spark: SparkSession, folder: str) -> DataFrame:
    e = enrolment(spark, folder)
    cust, od, ev, nation = (load(spark, folder, t) for t in ("customer", "orders", "events", "nation"))
    active = stage(plan.active_members(e, AS_OF), "active")
    found = stage(cases(spark, folder, active), "cases")
    empty = nation.select(F.col("n_nationkey").alias("category_id"), F.col("n_name").alias("category_name"))
    streams = stage(plan.case_streams(found, empty), "streams")
    mem = text("c_custkey").alias("memid")
    frame = plan.member_frame(
        active, streams, e,
        delegate=cust.filter(F.col("c_nationkey") < 20).select(mem, F.concat(F.lit("D"), text("c_nationkey")).alias("delegate")),
        pcp=cust.select(mem, F.when(F.col("c_acctbal") > 2000, "Y").otherwise("N").alias("currentpcp"), F.col("c_name").alias("assignedpcp"), F.lit("pay").alias("paytoname")),
        primary_cm=cust.select(mem, F.col("c_mktsegment").alias("ccacm"), text("c_nationkey").alias("Login ID")),
        directory=nation.select(text("n_nationkey").alias("employee_userid"), F.col("n_name").alias("employee_supervisorname")),
        merged=cust.select(F.concat(F.lit("C"), text("c_custkey")).alias("memberid"), F.when(F.col("c_acctbal") > 5000, "CCA").otherwise("X").alias("datasource"),
                           F.lit(date(1999, 1, 1)).alias("effdate"), F.lit(date(1999, 12, 31)).alias("termdate")),
        language=nation.select(F.concat(F.lit("l"), text("n_nationkey")).alias("languageid"), F.col("n_name").alias("description")), as_of=AS_OF)
    attributes = od.select(
        text("o_custkey").alias("memid"), _pick("o_orderpriority", {"1-URGENT": "C10163853", "2-HIGH": "C04423551"}, F.lit("X")).alias("attributeid"),
        F.col("o_orderdate").cast("date").alias("effdate"), _days(F.col("o_orderdate"), F.lit(700)).alias("termdate"))
    lines = load(spark, folder, "lineitem").select(F.concat(F.lit("cc"), text("l_linenumber")).alias("coveragecodeid")).distinct()
    visits = ev.select(F.concat(F.lit("C"), text("user_id")).alias("carriermemid"), F.when(F.col("event_type") == "view", 1).otherwise(2).alias("rankbysuccessful"),
                       F.col("ts").cast("timestamp").alias("Contact Date"))
    return plan.overlay_members(frame, e, found, attributes, lines.withColumn("description", F.lit("w")), visits, AS_OF)


OVERLAY = ["medicareid", "ccastratification", "enrollmentstatus", "healthhomemember", "ncr", "language", "vendorassignment", "currentpcp", "supervisor"]
DATES = ["mcpenrollmentdate", "mcptermdate", "mostrecenttermpriortoenrollmentgap", "mostrecentoptindate", "retroenrolledaftereffdate",
         "mostrecentsuccessfulf2f", "restricted effective date", "restricted term date", "ccabegindate"]


def member_overlay(spark: SparkSession, folder: str) -> DataFrame:
    """The frame after its overlays: one row for each case of a member."""
    out = _overlaid(spark, folder)
    plain = {c: F.coalesce(F.col(c), F.lit("-")) for c in OVERLAY}
    dates = {c.replace(" ", "_"): F.coalesce(day_text(F.to_date(F.col(c))), F.lit("-")) for c in DATES}
    case = {c: F.coalesce(text(c), F.lit("-")) for c in ("caseid", "ccaacuity", "ccaphase", "ccacasename")}
    plain |= case
    return out.select("carriermemid", "memid", "lob", "membername", "restricted", *[v.alias(c) for c, v in {**plain, **dates}.items()])


def member_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report, written to a catalog table and read back."""
    name = f"member_report_{uuid.uuid4().hex}"
    load_member_report(plan.member_report(_overlaid(spark, folder), NOW), name)
    out = table(spark, name)
    return out.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-")).alias(c.replace(" ", "_")) for c in out.columns])


QUERIES = {
    "member_active": member_active, "spans_in_force": spans_in_force, "care_stream": care_stream, "engagement": engagement,
    "enrol_gaps": enrol_gaps, "opt_transition": opt_transition, "member_overlay": member_overlay, "member_report": member_report,
}

_BASE = f"""
ek AS (SELECT 'e' || o_orderkey AS enrollid, CAST(o_custkey AS VARCHAR) AS memid, 'C' || o_custkey AS cm,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'QMXBP7971' WHEN o_orderpriority = '5-LOW' THEN 'QMXBP8050' ELSE 'QMXBP7938' END AS planid,
    CASE o_orderstatus WHEN 'F' THEN 'A1' WHEN 'O' THEN 'B1' ELSE 'H1' END AS rate,
    CASE WHEN o_totalprice > 450000 THEN 'ext' ELSE 'int' END AS seg, CAST(o_orderdate AS DATE) AS eff,
    CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 1000) AS INTEGER) AS term,
    CAST(o_orderdate AS DATE) + 5 - CAST(floor(o_totalprice / 50000) AS INTEGER) AS created FROM orders),
ec AS (SELECT 'e' || l_orderkey AS enrollid, CASE l_returnflag WHEN 'A' THEN 'A1' WHEN 'N' THEN 'B1' ELSE 'H2' END AS rate, 'cc' || l_linenumber AS cc,
    CAST(l_shipdate AS DATE) AS eff, CAST(l_shipdate AS DATE) + CAST(l_quantity * 10 AS INTEGER) AS term FROM lineitem),
mb AS (SELECT c_custkey AS cid, CAST(c_custkey AS VARCHAR) AS memid, DATE '1944-01-01' + CAST(trunc(c_acctbal * 2) AS INTEGER) AS dob, c_name, c_mktsegment AS mkt, c_nationkey AS nk, c_acctbal AS bal,
    CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'F' ELSE 'M' END AS sex FROM customer),
act AS (SELECT DISTINCT mb.memid, mkt || ', ' || c_name AS memname, dob, CAST(date_sub('year', dob, DATE '{AS_OF}') AS INTEGER) AS age, sex, 'n' || mb.memid AS entid, 'MMP' AS lob,
      ek.planid, ek.rate AS ratecode, cc AS coveragecodeid, cm AS carriermemid, ek.eff AS effdate, ek.term AS termdate, ek.eff AS lastupdate, ek.enrollid, cid, nk, bal
    FROM ek JOIN ec USING (enrollid) JOIN mb ON mb.memid = ek.memid
    WHERE seg = 'int' AND planid <> 'QMXBP8050' AND ek.term > ek.eff AND ec.term > ec.eff AND bal >= -500
      AND DATE '{AS_OF}' BETWEEN ek.eff AND ek.term AND DATE '{AS_OF}' BETWEEN ec.eff AND ec.term)"""
_CASES = """
oc AS (SELECT o_custkey AS cid, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 4 ELSE 2 END AS stat, o_orderpriority AS name, o_orderkey AS caseid,
    CASE WHEN o_totalprice < 480000 THEN CAST(floor(o_totalprice / 12000) AS INTEGER) END AS vf, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'),
cs AS (SELECT act.*, oc.caseid, oc.name, vf, day, r_name AS status, '18:NATION_' || caseid % 25 AS casetype,
      CASE caseid % 4 WHEN 0 THEN 'LOW' WHEN 1 THEN 'LOW' WHEN 2 THEN 'Catastrophic' ELSE '17:NATION_3' END AS acuity,
      CASE caseid % 3 WHEN 2 THEN 'Monitoring' ELSE 'Active' END AS phase
    FROM act JOIN oc USING (cid) JOIN region ON r_regionkey = stat WHERE bal >= 0)"""
_TYPES = ", ".join(f"({code}, '{name}')" for code, name in plan.values.CASE_TYPES)
_TYP = f"typ AS (SELECT * FROM (VALUES {_TYPES}) t(code, descr))"
_STREAM_RULE = """CASE WHEN {category} = 'Other' THEN '4' WHEN vf IN (2, 4) THEN '2' WHEN vf BETWEEN 1 AND 32 AND vf NOT IN (2, 4, 15, 16, 19, 22) THEN '3'
      WHEN vf IN (15, 16, 22, 19) THEN '1' WHEN sex <> 'F' AND age >= 21 OR sex = 'F' AND age >= 45 THEN '4'
      WHEN sex = 'F' AND age < 15 OR sex = 'M' AND age < 21 THEN '5' WHEN sex = 'F' THEN '1' END"""
_STREAM = f"""
{_TYP},
str AS (SELECT DISTINCT cid AS membercid, memname, carriermemid, memid, lob, 'p' || cid AS org_patientid, casetype, acuity, phase, sex, age, vf,
      coalesce(CASE WHEN n_regionkey = 3 THEN 'Other' WHEN n_regionkey > 1 THEN 'Cat' || n_name END, descr) AS category_name, caseid, name, status, day
    FROM cs LEFT JOIN nation ON n_nationkey = vf AND n_regionkey > 1 LEFT JOIN typ ON code = vf),
streams AS (SELECT *, {_STREAM_RULE.format(category='category_name')} AS stream FROM str)"""


def _gap_sql(spans: str, ties: str, cols: str) -> str:
    """Row number + self join on the next number, as the original formulates it."""
    return f"""
numb AS (SELECT *, row_number() OVER (PARTITION BY memid ORDER BY eff, term, {ties}) AS rn FROM {spans}),
gaps AS (SELECT a.*, b.eff AS eff2, date_diff('day', a.term, b.eff) AS gap, CASE WHEN b.eff - a.term > 90 THEN 1 ELSE 0 END AS restart,
      CASE WHEN b.eff - a.term >= 2 THEN 1 ELSE 0 END AS egap FROM numb a LEFT JOIN numb b ON a.memid = b.memid AND b.rn = a.rn + 1),
fe AS (SELECT memid, eff2 AS fe FROM gaps WHERE restart = 1 QUALIFY row_number() OVER (PARTITION BY memid ORDER BY rn DESC) = 1),
ft AS (SELECT memid, term AS ft FROM gaps WHERE egap = 1 QUALIFY row_number() OVER (PARTITION BY memid ORDER BY rn DESC) = 1),
per AS (SELECT memid, {cols} coalesce(max(fe.fe), min(eff)) AS firsteff, coalesce(max(ft.ft), max(term)) AS firstterm
    FROM gaps LEFT JOIN fe USING (memid) LEFT JOIN ft USING (memid) GROUP BY memid)"""


_OPT = """opt AS (SELECT o.memid, o.cm AS medicaidid, i.eff AS inn, date_diff('day', o.term, i.eff) AS days
    FROM ek o JOIN ek i ON o.memid = i.memid AND o.planid = 'QMXBP7938' AND i.planid = 'QMXBP7971' AND o.seg = 'int' AND i.seg = 'int'
      AND o.eff <= o.term AND i.eff <= i.term AND i.eff > o.term)"""

_OVER = f"""{_BASE}, {_CASES},
frame AS (SELECT DISTINCT a.carriermemid, a.memid, a.lob, c_name AS membername, mb.nk, mb.mkt, mb.bal, mb.dob FROM act a JOIN mb USING (memid)
    WHERE a.carriermemid IN (SELECT cm FROM ek WHERE seg = 'int' AND term > eff AND DATE '{AS_OF}' BETWEEN eff AND term)),
med AS (SELECT memid, max(cm) AS medicareid FROM ek WHERE planid = 'QMXBP8050' AND seg = 'int' AND eff < term AND DATE '{AS_OF}' BETWEEN eff AND term GROUP BY 1),
strat AS (SELECT memid, CASE WHEN acuity = 'LOW' AND phase = 'Active' THEN 'Low' WHEN acuity = 'LOW' THEN 'Monitoring' WHEN acuity = 'Catastrophic' THEN 'Intensive'
      ELSE acuity END AS s FROM cs QUALIFY row_number() OVER (PARTITION BY memid ORDER BY day DESC, caseid DESC) = 1),
att AS (SELECT CAST(o_custkey AS VARCHAR) AS memid, o_orderpriority AS p, CAST(o_orderdate AS DATE) AS eff, CAST(o_orderdate AS DATE) + 700 AS term FROM orders
    WHERE DATE '{AS_OF}' BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 700),
restr AS (SELECT memid, eff, term FROM att WHERE p = '1-URGENT' AND memid IN (SELECT memid FROM ek WHERE seg = 'int')
    QUALIFY row_number() OVER (PARTITION BY memid ORDER BY eff DESC, term DESC) = 1),
{_OPT}, optm AS (SELECT memid, max(inn) AS inn FROM opt GROUP BY 1),
spans AS (SELECT DISTINCT ek.memid, ec.eff, ec.term, cc, ec.rate FROM ek JOIN ec USING (enrollid) WHERE seg = 'int' AND ek.eff < ek.term AND planid <> 'QMXBP8050'
      AND ek.rate NOT LIKE 'H%' AND ek.eff <= DATE '{AS_OF}' AND ec.eff < ec.term AND ec.rate NOT LIKE 'H%' AND ec.eff <= DATE '{AS_OF}'),
{_gap_sql('spans', 'cc, rate', '')},
live AS (SELECT DISTINCT memid FROM spans WHERE DATE '{AS_OF}' BETWEEN eff AND term),
tmax AS (SELECT ek.memid, max(ek.term) AS t FROM ek JOIN ec USING (enrollid) WHERE seg = 'int' AND planid <> 'QMXBP8050' AND ek.rate NOT LIKE 'H%' AND ek.term > ek.eff
      AND ec.eff < ec.term AND ec.rate NOT LIKE 'H%' GROUP BY 1),
retro AS (SELECT per.memid, max(created) AS c FROM per JOIN ek ON ek.memid = per.memid AND ek.eff = per.firsteff AND seg = 'int' AND created >= firsteff GROUP BY 1),
visit AS (SELECT 'C' || user_id AS cm, max(ts) AS v FROM events WHERE event_type = 'view' GROUP BY 1),
over_ AS (SELECT f.*, medicareid, coalesce(s, ' ') AS strat, CASE WHEN restr.memid IS NULL THEN 0 ELSE 1 END AS restricted,
      coalesce(restr.eff, DATE '2078-12-31') AS reff, coalesce(restr.term, DATE '2078-12-31') AS rterm, coalesce(inn, DATE '2078-12-31') AS inn,
      coalesce(firsteff, DATE '2078-12-31') AS firsteff, coalesce(firstterm, DATE '2078-12-31') AS firstterm, CASE WHEN live.memid IS NULL THEN 'Disenrolled' ELSE 'Active' END AS es,
      coalesce(tmax.t, DATE '2078-12-31') AS tm, coalesce(retro.c, DATE '2078-12-31') AS rc, CASE WHEN f.memid IN (SELECT memid FROM att WHERE p = '2-HIGH') THEN 'X' ELSE '' END AS hh,
      CASE WHEN mkt = 'BUILDING' THEN 'Cherry Blossom' WHEN mkt = 'FURNITURE' THEN 'Restoration Plaza III' WHEN mkt = 'MACHINERY' AND nk < 12 THEN 'Stygler Commons(AL)' ELSE '' END AS ncr,
      coalesce(CAST(v AS DATE), DATE '2078-12-31') AS v
    FROM frame f LEFT JOIN med USING (memid) LEFT JOIN strat USING (memid) LEFT JOIN restr USING (memid) LEFT JOIN optm USING (memid) LEFT JOIN per USING (memid)
    LEFT JOIN live USING (memid) LEFT JOIN tmax USING (memid) LEFT JOIN retro USING (memid) LEFT JOIN visit ON visit.cm = f.carriermemid)"""

_DAY = "'%Y-%m-%d'"

ORACLE = {
    "member_active": f"""WITH {_BASE} SELECT memid, memname, strftime(dob, {_DAY}) AS dob, age, sex, entid, lob, planid, ratecode, coveragecodeid, carriermemid,
        strftime(effdate, {_DAY}) AS effdate, strftime(termdate, {_DAY}) AS termdate, strftime(lastupdate, {_DAY}) AS lastupdate, enrollid FROM act""",
    "spans_in_force": f"""WITH {_BASE}
        SELECT planid, count(*) AS n_rows, 'True' AS strict FROM ek WHERE DATE '{AS_OF}' BETWEEN eff AND term AND term > eff GROUP BY 1
        UNION ALL SELECT planid, count(*), 'False' FROM ek WHERE DATE '{AS_OF}' BETWEEN eff AND term GROUP BY 1""",
    "care_stream": f"""WITH {_BASE}, {_CASES}, {_STREAM} SELECT membercid, memname, carriermemid, memid, lob, org_patientid, casetype, acuity, phase, stream,
        category_name, caseid, name, status, strftime(day, {_DAY}) AS caseopendate, strftime(day, {_DAY}) AS consent_date, strftime(day, {_DAY}) AS lastupdated FROM streams""",
    "engagement": f"""
        WITH {_BASE}, {_CASES}, {_STREAM},
        s AS (SELECT carriermemid, CASE WHEN event_type = 'purchase' THEN '502474' ELSE '502476' END AS id, memname, user_id AS cid,
                CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(ts AS DATE) AS d FROM events JOIN streams ON membercid = user_id
            WHERE event_type IN ('view', 'click', 'purchase'))
        SELECT carriermemid, id, memname, cid, coalesce(id || ':' || n_name, '') AS engagementstatus, strftime(d, {_DAY}) AS update_time,
            CAST(row_number() OVER (PARTITION BY carriermemid ORDER BY id DESC, d, id || ':' || n_name NULLS FIRST) AS INTEGER) AS rnum
        FROM s LEFT JOIN nation ON n_nationkey = k""",
    "enrol_gaps": f"""WITH {_BASE}, {_gap_sql('ek', 'enrollid', "count(*) AS n_spans, CAST(sum(restart) AS BIGINT) AS restarts, CAST(sum(egap) AS BIGINT) AS gaps, CAST(coalesce(sum(gap), 0) AS BIGINT) AS gap_days,")}
        SELECT memid, n_spans, restarts, gaps, gap_days, strftime(firsteff, {_DAY}) AS firsteffdate, strftime(firstterm, {_DAY}) AS firsttermdate FROM per""",
    "opt_transition": f"""WITH {_BASE}, {_OPT} SELECT memid, medicaidid, strftime(max(inn), {_DAY}) AS latest_opt_in,
        CAST(min(days) FILTER (inn = m) AS INTEGER) AS days FROM (SELECT *, max(inn) OVER (PARTITION BY memid, medicaidid) AS m FROM opt) GROUP BY 1, 2""",
    "member_overlay": f"""WITH {_OVER}, held AS (SELECT DISTINCT carriermemid, caseid, acuity, phase, name FROM cs) SELECT carriermemid, memid, lob, membername, restricted, coalesce(medicareid, '-') AS medicareid, strat AS ccastratification,
        es AS enrollmentstatus, hh AS healthhomemember, ncr, 'NATION_' || nk AS language, CASE WHEN nk < 20 THEN 'D' || nk ELSE '-' END AS vendorassignment,
        CASE WHEN bal > 2000 THEN membername ELSE '-' END AS currentpcp, 'NATION_' || nk AS supervisor, strftime(firsteff, {_DAY}) AS mcpenrollmentdate,
        strftime(tm, {_DAY}) AS mcptermdate, strftime(firstterm, {_DAY}) AS mostrecenttermpriortoenrollmentgap, strftime(inn, {_DAY}) AS mostrecentoptindate,
        strftime(rc, {_DAY}) AS retroenrolledaftereffdate, strftime(v, {_DAY}) AS mostrecentsuccessfulf2f, strftime(reff, {_DAY}) AS restricted_effective_date,
        strftime(rterm, {_DAY}) AS restricted_term_date, CASE WHEN bal > 5000 THEN '1999-01-01' ELSE '-' END AS ccabegindate,
        coalesce(CAST(caseid AS VARCHAR), '-') AS caseid, coalesce(acuity, '-') AS ccaacuity, coalesce(phase, '-') AS ccaphase, coalesce(name, '-') AS ccacasename
        FROM over_ LEFT JOIN held USING (carriermemid)""",
    "member_report": f"""WITH {_OVER}, {_TYP},
        str AS (SELECT carriermemid, cid, acuity, caseid, casetype, coalesce(n_name, descr) AS cat, {_STREAM_RULE.format(category='coalesce(n_name, descr)')} AS stream
            FROM cs LEFT JOIN nation ON n_nationkey = vf LEFT JOIN typ ON code = vf),
        held AS (SELECT DISTINCT * FROM str)
        SELECT es AS enrollmentstatus, '-' AS memberdeceased, '-' AS membermoved, mkt AS primarycm, ' ' AS secondarycm, ' ' AS thirdcm,
            CASE WHEN nk < 20 THEN 'D' || nk ELSE '-' END AS vendorassignment, 'NATION_' || nk AS supervisor, hh AS healthhomemember, ncr, carriermemid,
            coalesce(medicareid, '-') AS medicareid, coalesce(CAST(cid AS VARCHAR), '-') AS membercid, membername, strftime(dob, {_DAY}) AS dob,
            CASE WHEN rc = DATE '2078-12-31' THEN '-' ELSE strftime(rc, {_DAY}) END AS retroenrolledaftereffdate, strftime(firsteff, {_DAY}) AS mcpenrolldate,
            strftime(tm, {_DAY}) AS mcptermdate, ' ' AS membertype, ' ' AS waivertype, '-' AS waivereffdate, '-' AS firstwspmilestonecreate, ' ' AS initialcdpsstrat,
            strat AS ccastratification, CASE WHEN bal > 5000 THEN '1999-01-01' ELSE '-' END AS ccabegindate, coalesce(acuity, '-') AS ccaacuity,
            coalesce(CASE stream WHEN '1' THEN 'Women of Reproductive age' WHEN '2' THEN 'Behavioral Health' WHEN '3' THEN 'Chronic Conditions'
                WHEN '4' THEN 'Healthy Adult' ELSE stream END, '-') AS population_stream, coalesce(cat, '-') AS ccacasecategory, '' AS engagementstatus,
            '-' AS engagementstatusstartdate, coalesce(CAST(caseid AS VARCHAR), '-') AS caseid, coalesce(casetype, '-') AS ccacasetype,
            'NEEDS ASSESSMENT' AS initial_assessment_type, '-' AS initial_assessment_date, '1999-06-01 08:00:00' AS createddate, 'PySpark' AS createdby
        FROM over_ LEFT JOIN held USING (carriermemid)""",
}
