"""Member audit: active members, their cases and care streams, and the member frame with its overlays."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age_years, effective
from ..functions.numbers import unsentinel
from ..functions.text import classify_like, first_match, ieq
from ..operators.joins import Overlay, decode_multi, overlay, star, update_from
from ..operators.ordered import numbered, top1
from ..operators.rows import with_defaults
from ..operators.spans import continuous_start, days_since_opt_out, span_gaps, term_before_gap
from ..sources.sinks import load_stamps
from ..sources.staging import stage
from ..sources.tables import lookup
from . import member_values as values


@dataclass(frozen=True)
class Enrolment:
    """The enrolment tables every member step starts from."""

    keys: DataFrame
    coverage: DataFrame
    member: DataFrame
    entity: DataFrame


def line_of_business(planid: Column) -> Column:
    return first_match([(planid.isin(values.PLANS), F.lit("MMP"))], F.lit("Unknown"))


def population_group(ratecode: Column) -> Column:
    return first_match([(ratecode.like("%A%"), F.lit("Group A"))], F.lit("Group B"))


def _internal(keys: DataFrame) -> DataFrame:
    return keys.filter(ieq(F.col("segtype"), "int"))


def active_members(e: Enrolment, as_of: date) -> DataFrame:
    """Enrolments in force on the day, with the member's name, age and line of business."""
    keys = _internal(e.keys).filter(F.col("planid").isin(values.PLANS) & effective(F.col("effdate"), F.col("termdate"), as_of))
    coverage = (e.coverage.filter((F.col("ratecode") != values.EXCLUDED_RATE) & effective(F.col("effdate"), F.col("termdate"), as_of))
                .select("enrollid", "coveragecodeid"))
    people = e.entity.filter((F.col("termdate") > F.lit(as_of)) & (F.col("enttype") == "Member")).select(
        F.col("entid").alias("entityid"), "lastname", "firstname")
    rows = (keys.join(coverage, "enrollid")
            .join(e.member.select("memid", "entityid", "dob", "sex"), "memid").join(people, "entityid"))
    return rows.select(
        "memid", F.concat(F.rtrim("lastname"), F.lit(", "), F.rtrim("firstname")).alias("memname"), "dob",
        age_years(F.col("dob"), as_of).alias("age"), "sex", F.col("entityid").alias("entid"),
        line_of_business(F.col("planid")).alias("lob"), "planid", "ratecode", "coveragecodeid", "carriermemid", "effdate",
        "termdate", "lastupdate", "enrollid").distinct()


def member_cases(active: DataFrame, cca_member: DataFrame, org_patient: DataFrame, org_case: DataFrame,
                 string_locale: DataFrame, case_status: DataFrame) -> DataFrame:
    """Cases of active members with decoded type, acuity and phase. Members without a case drop out."""
    mbr = (cca_member.filter(F.col("employer") == "5")
           .select("cid", F.rtrim("medicaid_no").alias("carriermemid"), F.col("date_of_birth").alias("dob"), "temp_cid_link"))
    patient = org_patient.select("cid", "id")
    case = (org_case.filter(F.col("status").isin("1", "4") & (F.col("name") != "General") & (F.col("type_id") != "1"))
            .select(F.col("patient_id").alias("id"), "status", "name", "tzx_type", "acuity", "phase", "vf_01", "tzix_id", "diagnosis",
                    "open_date", "consent_type", "consent_date", "update_date"))
    status = case_status.select(F.col("id").alias("_status_id"), F.col("status").alias("case_status"))
    rows = star(active, [
        (mbr, ["carriermemid", "dob"], "left"),
        (patient, ["cid"], "left"),
        (case, ["id"], "left"),
        (status, F.col("status") == F.col("_status_id"), "inner"),
    ])
    code = F.col
    rows = decode_multi(rows, string_locale, "sub_id", "string", {
        "casetype": ("tzx_type", (code("id") == "18") & (code("mg_id") == "50") & (code("type_id") == "9")),
        "acuity_text": ("acuity", (code("id") == "17") & (code("type_id") == "9")),
        "phase_text": ("phase", (code("id") == "101") & (code("type_id") == "9") & (code("mg_id") == "50") & (code("inactive") == "0")),
    })
    keys = {
        "memid": "memid", "memname": "memname", "dob": "dob", "age": "age", "sex": "sex", "entid": "entid", "lob": "lob",
        "planid": "planid", "ratecode": "ratecode", "coveragecodeid": "coveragecodeid", "carriermemid": "carriermemid",
        "effdate": "effdate", "termdate": "termdate", "lastupdate": "lastupdate", "enrollid": "enrollid", "id": "id", "cid": "cid",
        "tzix_id": "caseid", "name": "name", "diagnosis": "diagnosis", "open_date": "caseopendate", "casetype": "casetype",
        "acuity_text": "acuity", "phase_text": "phase", "consent_type": "consent_type", "vf_01": "vf_01",
        "case_status": "status", "temp_cid_link": "temp_cid_link",
    }
    return (rows.select(*[F.col(c).alias(n) for c, n in keys.items()], "consent_date", "update_date")
            .groupBy(*keys.values())
            .agg(F.max("consent_date").alias("consent_date"), F.max("update_date").alias("lastupdated")))


def care_stream(code: Column, sex: Column, age: Column) -> Column:
    listed = code.isin(values.BEHAVIORAL + values.MATERNITY + [c for c, _ in values.CHRONIC])
    other = code.isNull() | ~listed
    adult = ((sex != "F") & (age >= 21)) | ((sex == "F") & (age >= 45))
    child = ((sex == "F") & (age < 15)) | ((sex == "M") & (age < 21))
    return first_match([
        (code.isin(values.BEHAVIORAL), F.lit("2")),
        (code.isin([c for c, _ in values.CHRONIC]), F.lit("3")),
        (code.isin(values.MATERNITY), F.lit("1")),
        (other & adult, F.lit("4")),
        (other & child, F.lit("5")),
        (other & (sex == "F") & age.between(15, 44), F.lit("1")),
    ])


def case_streams(cases: DataFrame, case_category: DataFrame) -> DataFrame:
    """One row per case with its category and care stream.

    The case rows carry the member columns already, so the member frame is not joined a second time.
    """
    types = lookup(cases.sparkSession, values.CASE_TYPES, "dct_id string, dct_description string")
    category = case_category.select(F.col("category_id").cast("string").alias("_category_id"), F.col("category_name").alias("catname"))
    rows = (cases.join(category, F.col("vf_01") == F.col("_category_id"), "left")
            .join(types, F.col("vf_01") == F.col("dct_id"), "left"))
    rows = (rows.groupBy("cid", "memname", "carriermemid", "memid", "lob", "id", "casetype", "acuity", "caseid", "vf_01", "sex", "age",
                         "catname", "dct_description", "name", "status", "caseopendate", "consent_type", "diagnosis", "phase")
            .agg(F.max("consent_date").alias("consent_date"), F.max("lastupdated").alias("lastupdated"))
            .withColumn("category_name", F.coalesce("catname", "dct_description")))
    stream = F.when(F.col("category_name") == "Other", "4").otherwise(care_stream(F.col("vf_01"), F.col("sex"), F.col("age")))
    return rows.select(
        F.col("cid").alias("membercid"), "memname", "carriermemid", "memid", "lob", F.col("id").alias("org_patientid"), "casetype",
        "acuity", "phase", stream.alias("population stream"), "category_name", "caseid", "name", "status", "caseopendate",
        "consent_type", "consent_date", "lastupdated", "diagnosis")


def engagement(streams: DataFrame, member_concept: DataFrame, concept: DataFrame, string_locale: DataFrame) -> DataFrame:
    """Engagement entries of each member, newest concept first, numbered."""
    wanted = concept.filter(F.col("id").isin(values.ENGAGEMENT_CONCEPTS)).select("id")
    said = member_concept.select(F.col("cid").alias("membercid"), F.col("concept_id").alias("id"), "str_value",
                                 F.to_date("update_time").alias("update_time"))
    texts = string_locale.select("id", F.col("sub_id").cast("string").alias("str_value"), F.col("string").alias("engagementstatus"))
    rows = (streams.select("membercid", "carriermemid", "memname").join(said, "membercid")
            .join(wanted, "id").join(texts, ["id", "str_value"], "left")
            .select("carriermemid", "id", "memname", F.col("membercid").alias("cid"), "engagementstatus", "update_time"))
    order = [F.col("id").desc_nulls_last(), F.col("update_time").asc_nulls_first(), F.col("engagementstatus").asc_nulls_first(),
             F.col("cid").asc_nulls_first()]
    # a bucket must not run against the order: id first, then month
    month = F.struct((-F.col("id").cast("bigint")).alias("id"), F.trunc("update_time", "month").alias("month"))
    return numbered(rows, ["carriermemid"], order, "rnum", bucket=month)


def member_frame(active: DataFrame, streams: DataFrame, e: Enrolment, delegate: DataFrame, pcp: DataFrame, primary_cm: DataFrame,
                 directory: DataFrame, merged: DataFrame, language: DataFrame, as_of: date) -> DataFrame:
    """Known members, a row for each of their cases, with placeholders for everything the overlays fill in."""
    named = active.select("carriermemid", "memid", "lob").unionByName(streams.select("carriermemid", "memid", "lob"))
    members = top1(named.distinct(), ["carriermemid"], [F.col("lob").asc_nulls_first(), F.col("memid").asc_nulls_first()])
    newest_entity = top1(
        e.entity.select(F.col("entid").alias("entityid"), "phyaddr1", "phyaddr2", F.col("phycity").alias("city"),
                        F.col("phycounty").alias("county"), F.col("phyzip").alias("zip"), "phone", "termdate"),
        ["entityid"], [F.col("termdate").desc_nulls_last(), F.col("phyaddr1").asc_nulls_last(), F.col("phone").asc_nulls_last()]
    ).drop("termdate")
    person = e.member.select("memid", "entityid", F.col("fullname").alias("membername"), F.to_date("dob").alias("dob"),
                             F.col("primarylanguage").alias("languageid"))
    cases = streams.select(
        "memid", "membercid", F.col("acuity").alias("ccaacuity"), F.col("phase").alias("ccaphase"), "population stream",
        F.col("category_name").alias("ccacasecategory"), F.col("name").alias("ccacasename"), "caseid",
        F.col("casetype").alias("ccacasetype"), F.col("caseopendate").alias("ccacaseopendate"),
        F.col("lastupdated").alias("careplanrevisiondate"))
    in_force = _internal(e.keys).filter(effective(F.col("effdate"), F.col("termdate"), as_of)).select("carriermemid")
    rows = star(members, [
        (person, ["memid"], "inner"),
        (language.select("languageid", F.col("description").alias("language")), ["languageid"], "inner"),
        (in_force, ["carriermemid"], "left_semi"),
        (cases, ["memid"], "left"),
        (delegate.select("memid", F.col("delegate").alias("vendorassignment")), ["memid"], "left"),
        (pcp.filter(F.col("currentpcp") == "Y").select("memid", F.col("assignedpcp").alias("currentpcp"), "paytoname"), ["memid"], "left"),
        (primary_cm.select("memid", F.col("ccacm").alias("primarycm"), F.col("Login ID").alias("_login")), ["memid"], "left"),
        (directory.select(F.col("employee_userid").alias("_login"), F.col("employee_supervisorname").alias("supervisor")), ["_login"], "left"),
        (newest_entity, ["entityid"], "left"),
        (merged.filter((F.col("datasource") == "CCA") & effective(F.col("effdate"), F.col("termdate"), as_of, strict=False))
         .select(F.col("memberid").alias("carriermemid"), F.col("effdate").alias("ccabegindate")), ["carriermemid"], "left"),
    ])
    return with_defaults(rows.drop("_login", "languageid").distinct(), values.PLACEHOLDERS)


def opt_in_after_opt_out(keys: DataFrame, opt_out_plan: str = values.OPT_OUT_PLAN, opt_in_plan: str = values.OPT_IN_PLAN) -> DataFrame:
    """Member's latest opt-in that began after an opt-out ended."""
    spans = _internal(keys).select("memid", F.col("carriermemid").alias("medicaidid"), F.col("effdate").alias("eff"),
                                   F.col("termdate").alias("term"), "planid")
    return days_since_opt_out(spans.filter(F.col("planid") == opt_out_plan), spans.filter(F.col("planid") == opt_in_plan),
                              "memid", ["medicaidid"])


def enrolment_dates(spans: DataFrame, as_of: date, bucket: Column | None = None) -> DataFrame:
    """Per member: start of the current stretch, end before the last gap, and whether a span is in force."""
    ties = ["coveragecodeid", "ratecode"]
    gaps = span_gaps(spans, "memid", "effdate", "termdate", ties, bucket=F.trunc("effdate", "month") if bucket is None else bucket)
    live = effective(F.col("effdate"), F.col("termdate"), as_of, strict=False)
    return gaps.groupBy("memid").agg(
        continuous_start("effdate").alias("firsteffdate"),
        term_before_gap("effdate", "termdate", ties).alias("mostrecenttermdatewithgap"),
        F.max(F.when(live, 1).otherwise(0)).alias("is_active"))


def building(addr: Column, other_addr: Column, city: Column) -> Column:
    """Building name by street pattern on either address, in rule order; one rule asks for the city as well."""
    before = classify_like([addr, other_addr], values.BUILDINGS)
    with_city = addr.ilike(values.CITY_BUILDING[0]) & city.ilike(values.CITY_BUILDING[1])
    after = classify_like([addr, other_addr], values.BUILDINGS_AFTER_CITY)
    return first_match([(before != "", before), (with_city, F.lit(values.CITY_BUILDING[2]))], after)


def _enrolled(e: Enrolment, as_of: date) -> DataFrame:
    """One row per member, carrier id and start: whether it is a Medicare span in force, the first end of an opt-out, the
    last start of an opt-in, and the last entry that was made on the start or later."""
    col, lasting = F.col, F.col("effdate") <= F.col("termdate")
    medicare = (col("planid") == values.MEDICARE_PLAN) & effective(col("effdate"), col("termdate"), as_of)
    plan_is = lambda plan: lasting & (col("planid") == plan)
    return _internal(e.keys).groupBy("memid", "carriermemid", "effdate").agg(
        F.max(medicare).alias("medicare"),
        F.min(F.when(plan_is(values.OPT_OUT_PLAN), col("termdate"))).alias("first_out"),
        F.max(F.when(plan_is(values.OPT_IN_PLAN), col("effdate"))).alias("last_in"),
        F.max(F.when(col("createdate") >= col("effdate"), col("createdate"))).alias("entered"))


def _covered(e: Enrolment, coverage_code: DataFrame, as_of: date) -> DataFrame:
    """Enrolments of the line of business with their coverages: what the covered spans and the last end are read from."""
    spans = _internal(e.keys).filter(line_of_business(F.col("planid")).like("MMP%")).select(
        "memid", "enrollid", F.col("termdate").alias("enrolment_end"), _begun(as_of).alias("key_begun"), _kept().alias("key_kept"))
    coverage = e.coverage.select("enrollid", "effdate", "termdate", "coveragecodeid", "ratecode",
                                 _begun(as_of).alias("begun"), _kept().alias("kept"))
    waiver = coverage_code.select("coveragecodeid", F.col("description").alias("waivertype"))
    return spans.join(coverage.filter("begun or kept"), "enrollid").join(waiver, "coveragecodeid", "left")


def _kept() -> Column:
    return (F.col("termdate") > F.col("effdate")) & ~F.col("ratecode").like("H%")


def _begun(as_of: date) -> Column:
    return _kept() & (F.col("effdate") <= F.lit(as_of))


def overlay_members(frame: DataFrame, e: Enrolment, cases: DataFrame, attributes: DataFrame, coverage_code: DataFrame,
                    visits: DataFrame, as_of: date) -> DataFrame:
    """The overlay steps; the frame keeps its rows, and those of one member (its cases) get the same values.

    Sources with the same key are one union and one join (``overlay``): those by member, those by carrier id, and last the
    entry date, whose key is a date that the others set. The enrolment keys are scanned twice, alone and with coverages.
    """
    col = F.col
    held = lambda attribute: (col("attributeid") == attribute) & effective(col("effdate"), col("termdate"), as_of, strict=False)
    level = first_match([
        (ieq(col("acuity"), "low") & (col("phase") == "Active"), F.lit("Low")),
        (ieq(col("acuity"), "low") & (col("phase") == "Monitoring"), F.lit("Monitoring")),
        (col("acuity") == "Catastrophic", F.lit("Intensive")),
    ], col("acuity"))
    enrolled = stage(_enrolled(e, as_of), "enrolled")
    opted = (enrolled.groupBy("memid").agg(F.max("last_in").alias("latest_opt_in"), F.min("first_out").alias("first_out"))
             .filter(col("latest_opt_in") > col("first_out")))
    covered = stage(_covered(e, coverage_code, as_of), "covered")
    spans = covered.filter("key_begun and begun").select("memid", "effdate", "termdate", "coveragecodeid", "waivertype", "ratecode").distinct()
    dates = enrolment_dates(spans, as_of)
    ended = covered.filter("key_kept and kept").groupBy("memid").agg(F.max("enrolment_end").alias("maxtermdate"))
    homes = attributes.filter(held(values.HEALTH_HOME_ATTRIBUTE)).select("memid").distinct()
    addresses = (e.entity.join(e.member.select("memid", col("entityid").alias("entid")), "entid")
                 .select("memid", building(col("addr1"), col("phyaddr1"), col("city")).alias("ncr")))
    out = overlay(frame.withColumn("enrollmentstatus", F.lit("Disenrolled")), "memid", [
        Overlay(enrolled.filter("medicare"), "memid", {"medicareid": col("carriermemid")}),
        Overlay(cases, "memid", {"ccastratification": level}, "flag", [col("lastupdated"), col("caseid")]),
        Overlay(opted, "memid", {"mostrecentoptindate": col("latest_opt_in")}),
        Overlay(dates, "memid", {"mcpenrollmentdate": col("firsteffdate"),
                                 "mostrecenttermpriortoenrollmentgap": col("mostrecenttermdatewithgap"),
                                 "enrollmentstatus": F.when(col("is_active") == 1, "Active")}),
        Overlay(ended, "memid", {"mcptermdate": col("maxtermdate")}),
        Overlay(homes, "memid", {"healthhomemember": F.lit("X")}),
        Overlay(addresses, "memid", {"ncr": col("ncr")}),
    ])
    spans_held = attributes.filter(held(values.RESTRICTED_ATTRIBUTE)).select(
        "memid", col("effdate").alias("maeffdate"), col("termdate").alias("matermdate"))
    restricted = enrolled.select("memid", "carriermemid").distinct().join(spans_held, "memid")
    seen = visits.filter(col("rankbysuccessful") == 1).select("carriermemid", col("Contact Date").alias("contact"))
    out = overlay(out, "carriermemid", [
        Overlay(restricted, "carriermemid", {"restricted": F.lit(1), "restricted effective date": col("maeffdate"),
                                             "restricted term date": col("matermdate")}, "flag", [col("maeffdate"), col("matermdate")]),
        Overlay(seen, "carriermemid", {"mostrecentsuccessfulf2f": col("contact")}),
    ])
    late = (enrolled.filter("entered is not null").groupBy("memid", col("effdate").cast("timestamp").alias("effdate"))
            .agg(F.max("entered").alias("entered")))
    return update_from(out, late, {"memid": "memid", "mcpenrollmentdate": "effdate"}, {"retroenrolledaftereffdate": col("entered")})


def member_report(overlaid: DataFrame, at: datetime, by: str = "PySpark") -> DataFrame:
    """The report columns that depend on the member frame alone, placeholders turned back into NULL."""
    back = lambda c: unsentinel(F.col(c), values.SENTINEL)
    stream = F.col("population stream")
    label = first_match([(stream == k, F.lit(v)) for k, v in values.STREAM_LABELS], stream)
    out = overlaid.select(
        "enrollmentstatus", back("memberdeceased").alias("memberdeceased"), back("mmpmembermoved").alias("membermoved"),
        "primarycm", "secondarycm", "thirdcm",
        F.when(F.col("secondarycm").ilike("Blackstone%"), "Blackstone").otherwise(F.col("vendorassignment")).alias("vendorassignment"),
        "supervisor", "healthhomemember", "ncr", "carriermemid", "medicareid", "membercid", "membername", "dob",
        back("retroenrolledaftereffdate").alias("retroenrolledaftereffdate"),
        F.to_date("mcpenrollmentdate").alias("mcpenrolldate"), F.to_date("mcptermdate").alias("mcptermdate"),
        "membertype", "waivertype", back("waivereffdate").alias("waivereffdate"),
        back("firstwsp/pcspmilestonecreate").alias("firstwspmilestonecreate"), "initialcdpsstrat", "ccastratification",
        "ccabegindate", "ccaacuity", label.alias("population stream"), "ccacasecategory", F.lit("").alias("engagementstatus"),
        F.lit(None).cast("date").alias("engagementstatusstartdate"), "caseid", "ccacasetype",
        F.when(F.rtrim("firstassessmenttype") == "", "NEEDS ASSESSMENT").otherwise(F.col("firstassessmenttype")).alias("initial assessment type"),
        back("initialassessment").alias("initial assessment date"))
    return load_stamps(out, at, by)
