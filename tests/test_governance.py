"""Masks, row filters, tags, classification, quality checks, metadata schemas."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from tidemark.functions.dates import ntz
from tidemark.operators import classify, policies, tags
from tidemark.operators.changes import change_feed
from tidemark.operators.constructor import schema_from_metadata
from tidemark.operators.nested import flatten_classification
from tidemark.operators.quality import Check, check_keys, dq_not_null, run_checks

M = policies.MASKED


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [("user_1@masking.example", "Public"), ("user_2@masking.example", "Private")], "user_email string, status string")


def test_masks(people):
    shown = ["user_1@masking.example", "user_2@masking.example"]
    emails = lambda df: [r.user_email for r in df.orderBy(F.col("status").desc()).collect()]
    assert emails(policies.mask(people, "user_email", "ADMIN", ["ADMIN"])) == shown
    assert emails(policies.mask(people, "user_email", "OTHER", ["ADMIN"])) == [M, M]
    public = F.col("status") == "Public"
    assert emails(policies.mask_when(people, "user_email", "OTHER", ["ADMIN"], public)) == [shown[0], M]
    assert policies.row_filter(people, F.lit("OTHER") == "ADMIN").count() == 0


def test_policies_follow_the_table(spark, people):
    rules = policies.PolicySet()
    rules.set_mask("people", "user_email", "p1", lambda role, df: policies.masked(F.col("user_email"), role, ["ADMIN"]))
    seen = rules.apply("PEOPLE", people, "OTHER")
    feed = change_feed(seen.limit(0), seen.filter("status = 'Public'"), "status")
    assert rows(feed, "user_email") == [(M,)]
    rules.add_row_policy("people", "p2", lambda role, df: F.lit(role == "ADMIN"))
    assert rules.apply("people", people, "OTHER").count() == 0 and rules.apply("people", people, "ADMIN").count() == 2
    assert rows(rules.references(spark)) == [("p1", "MASKING_POLICY", "people", "user_email"), ("p2", "ROW_ACCESS_POLICY", "people", None)]
    rules.unset_mask("people", "user_email")
    rules.drop_row_policy("people")
    assert rows(rules.apply("people", people, "OTHER")) == rows(people)


@pytest.fixture(scope="module")
def catalogue(spark):
    tag = spark.createDataFrame([(1, "PII", "Personal"), (2, "PII_S_NAME", "Name"), (3, "PII_N_GENDER", "Gender")], "tag_id int, name string, comment string")
    obj = spark.createDataFrame(
        [(10, "TEST", "public", "employee", None), (11, "TEST", "public", "employee", "name"), (12, "TEST", "public", "employee", "gender")],
        "object_id int, database string, schema string, name string, attribute string")
    asked = spark.createDataFrame(
        [("PII", "TEST", "public", "employee", None), ("PII_S_NAME", "TEST", "public", "employee", "name"),
         ("PII_N_GENDER", "TEST", "public", "employee", "gender"), ("NONE", "TEST", "public", "employee", "gender")],
        "tag_name string, database string, schema string, object_name string, attribute string")
    return tag, obj, asked


def test_tags(spark, catalogue):
    tag, obj, asked = catalogue
    assigned = tags.assign_tag(asked, tag, obj)
    assert rows(assigned) == [(10000, 1, 10), (10001, 2, 11), (10002, 3, 12)]
    star = tags.tag_objects(assigned, tag, obj)
    assert star.filter("attribute is null").count() == 1
    statements = rows(tags.render_tags(star), "apply_tag_stmt")
    assert statements[0] == ("ALTER TABLE TEST.public.employee MODIFY COLUMN gender SET TAG PII_N_GENDER = 'Gender';",)
    assert statements[2] == ("ALTER TABLE TEST.public.employee SET TAG PII = 'Personal';",)
    columns = spark.createDataFrame([("employee", c) for c in ("id", "name", "gender")], "object_name string, column_name string")
    every = tags.tag_references(star, columns)
    assert rows(every, "column_name", "tag_name", "inherited") == [
        ("gender", "PII", True), ("gender", "PII_N_GENDER", False), ("id", "PII", True), ("name", "PII", True), ("name", "PII_S_NAME", False)]
    assert rows(tags.tag_value(tags.tag_references(star, columns, "COLUMN"), "PII_S_NAME", "employee", "name")) == [("Name",)]
    assert rows(tags.tag_value(tags.tag_references(star, columns, "TABLE"), "PII", "employee")) == [("Personal",)]


def test_allowed_values(spark):
    assign = spark.createDataFrame([("a", "ok"), ("a", "bad"), ("free", "any")], "tag_name string, tag_value string")
    allowed = spark.createDataFrame([("a", "ok")], "tag_name string, tag_value string")
    assert rows(tags.invalid_tag_values(assign, allowed)) == [("a", "bad")]


def test_lineage_ends_on_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("x", "y")], "upstream string, downstream string")
    assign = spark.createDataFrame([("T", "a"), ("U", "x")], "tag_name string, object_name string")
    assert rows(tags.tag_lineage(assign, edges, "T")) == [("T", "a", 0), ("T", "b", 1), ("T", "c", 1)]


def test_classification(spark):
    sailors = spark.createDataFrame(
        [(1, "Ida Berg", "female", "QQ654321C", "901-23-4567", "AB1 2CD", "10001"),
         (2, "Ole Lund", "male", "WW765432D", "912-34-5678", "XY21 3ZZ", "10002")],
        "sailor_no int, name string, sex string, insurance string, social string, post string, zip string")
    found = classify.classify_columns(sailors, path="t")
    assert rows(found.filter("privacy_category is not null"), "attribute", "semantic_category") == [
        ("insurance", "UK_NATIONAL_INSURANCE"), ("post", "UK_POSTCODE"), ("sex", "GENDER"), ("social", "US_SSN"), ("zip", "US_POSTAL_CODE")]
    flat = flatten_classification(classify.classification_document(found), "doc", "path_to_object", ntz("2022-01-01 00:00:00"))
    assert flat.count() == 5
    assert classify.classify_columns(sailors.limit(0)).filter("privacy_category is not null").count() == 0


def test_patterns_end_where_the_value_ends(spark):
    df = spark.createDataFrame([("12345\n",), ("12345-6789\r\n",), ("12345",)], "v string")
    zip_rule = next(r for r in classify.RULES if r.semantic_category == "US_POSTAL_CODE")
    assert [r[0] for r in df.filter(zip_rule.fits(F.col("v"))).collect()] == ["12345"]


def test_classification_guards_change_nothing(spark):
    values = ["a@b.co", "a b@c.co", "123-45-6789", "123-45-67890", "http://x/" + "y" * 5000, "1.2.3.4", "AB1 2CD", "ab", "abc", "12345-6789", "", "é"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for rule in classify.RULES:
        assert df.filter(rule.fits(F.col("v"))).count() == df.filter(F.col("v").rlike(rule.pattern)).count()


@pytest.fixture(scope="module")
def codes(spark):
    return spark.createDataFrame([(10000, "ATTRIBUTE_IS_NULL"), (10001, "NEGATIVE")],
                                 "data_quality_exception_code_id int, data_quality_exception_code_name string")


def test_quality(spark, codes):
    df = spark.createDataFrame([(1, None, "Y"), (2, None, "N"), (3, "x", "Y"), (None, "y", "Y"), (-4, "z", "Y")], "id int, content string, current_flag string")
    found = dq_not_null(df, "content", "id", codes, "2022-01-01 00:00:00", "t")
    assert rows(found, "data_quality_exception_id", "source_record_pk_info", "source_record_pk_value") == [(10000, "id", "1")]
    checks = [Check("id", "id", "t"), Check("content", "id", "t"), Check("id", "id", "t", code="NEGATIVE", fails=F.col("id") < 0)]
    suite = run_checks(df, checks, codes, "2022-01-01 00:00:00")
    assert rows(suite, "source_attribute_name", "data_quality_exception_code_id", "source_record_pk_value") == [
        ("content", 10000, "1"), ("id", 10000, None), ("id", 10001, "-4")]
    assert sorted(r[0] for r in suite.collect()) == [10000, 10001, 10002]


def test_keys(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 9), (None, "b", None)], "id int, u string, f int")
    parent = spark.createDataFrame([(1,)], "p int")
    got = rows(check_keys(df, ["id"], [["u"]], [(["f"], parent, ["p"])], ["f"]))
    assert got == [("foreign", "f", "9", 1), ("not_null", "f", "NULL", 1), ("primary", "id", "1", 2), ("primary", "id", "NULL", 1), ("unique", "u", "b", 2)]
    with pytest.raises(ValueError):
        check_keys(df)


def test_constructor(spark):
    ddl = ("dataset string, position string, label string, source_attribute string, source_datatype string, source_precision string,"
           " target_attribute string, target_datatype string, target_precision string")
    data = [("EMPLOYEE", "1", "STAGING_TABLE", "STG_EMPLOYEE", "PUBLIC", None, None, None, None),
            ("EMPLOYEE", "10", "DATE_MASTER_KEY", "LOADED", "TIMESTAMP_NTZ", None, None, None, None),
            ("EMPLOYEE", "9", "ATTRIBUTE", "SALARY", "NUMBER", "10,2", "PAY", "NUMBER", "18,4"),
            ("EMPLOYEE", "2", "PRIMARY_KEY", "EMPLOYEE_ID", "NUMBER", "10", None, None, None),
            ("OTHER", "1", "PRIMARY_KEY", "X", "VARCHAR", "5", None, None, None)]
    built = schema_from_metadata(spark.createDataFrame(data, ddl), "EMPLOYEE")
    assert built.table == "public.stg_employee" and built.sequence == "public.seq_stg_employee_id" and built.feed == "public.strm_stg_employee"
    assert built.ddl() == "employee_id decimal(10,0), salary decimal(10,2), loaded timestamp_ntz"
    assert built.target["pay"].dataType == T.DecimalType(18, 4)
    assert (built.primary_key, built.attributes, built.date_keys) == (("employee_id",), ("salary",), ("loaded",))


def test_key_checks_group_each_key_once(spark):
    """A key's rows are counted before and after the shuffle and not grouped again; NULL keys are one group."""
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 3), (None, 3)], "a int, b int")
    found = check_keys(df, primary=["a"], not_null=["a"])
    assert found._jdf.queryExecution().executedPlan().toString().count("HashAggregate") == 4
    assert sorted(tuple(r) for r in found.collect()) == [("not_null", "a", "NULL", 2), ("primary", "a", "1", 2), ("primary", "a", "NULL", 2)]
