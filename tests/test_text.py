import json

from pyspark.sql import functions as F

from tidemark.functions import text


def test_identifier(spark):
    mails = ["Jane.Doe@example.com", "__x--1@y", "PLAIN", "a@b@c", "ümlaut@x"]
    df = spark.createDataFrame([(m,) for m in mails], "m string")
    assert [r[0] for r in df.select(text.identifier(F.col("m"))).collect()] == ["jane_doe", "x__1", "plain", "a", "mlaut"]


def test_texts(spark):
    row = spark.range(1).select(
        text.version_tag(F.lit("m"), F.lit(3)).alias("tag"),
        text.percent_text(F.lit(0.265)).alias("percent"),
        text.range_text(F.lit(1), F.lit(2.3)).alias("range"),
    ).first()
    assert tuple(row) == ("m_v3", "26.5%", "[1.00, 2.30]")


def test_ranges_have_no_negative_zero(spark):
    pairs = [(-0.0, 0.0), (0.0, -0.0), (-0.004, -0.0), (-0.006, 1.005), (-12.5, 1e12 + 0.25)]
    df = spark.createDataFrame(pairs, "low double, high double")
    found = [r[0] for r in df.select(text.range_text(F.col("low"), F.col("high"))).collect()]
    assert found == ["[0.00, 0.00]"] * 3 + ["[-0.01, 1.01]", "[-12.50, 1000000000000.25]"]


def test_shares_round_halves_up_where_the_product_falls_below(spark):
    pairs = [(4050, 900000, "0.5%"), (16650, 900000, "1.9%"), (3, 20000, "0.0%"), (41, 100, "41.0%"), (0, 7, "0.0%"), (7, 7, "100.0%")]
    df = spark.createDataFrame(pairs, "k long, n long, wanted string")
    found = [tuple(r) for r in df.select(text.percent_text(F.col("k") / F.col("n")), "wanted").collect()]
    assert [a for a, _ in found] == [b for _, b in found]
    assert spark.range(1).select(text.percent_text(F.lit(-0.0001), 1), text.percent_text(F.lit(0.28505), 2)).first()[:] == ("0.0%", "28.51%")


def test_prompt(spark):
    df = spark.createDataFrame([("C1", 3, None, "{{prediction}}")], "id string, tenure int, plan string, note string")
    lines = text.profile_lines(df, "id")
    out = df.select(text.prompt_text("P={{prediction}}\n{{customer_lines}}\nEnd", F.lit(1), lines)).first()[0]
    assert out == "P=1\n  tenure: 3\n  plan: None\n  note: {{prediction}}\nEnd"


def test_responses(spark):
    detail = {
        "finishReason": "input_guardrail_triggered",
        "input_guardrail": [
            {"flagged": True, "categories": {"violence": True, "hate": False, "self-harm": True}},
            {"flagged": False, "categories": {"other": True}},
        ],
        "output_guardrail": [{"flagged": True, "categories": {"pii": True}}],
    }
    bodies = [
        (1, 200, json.dumps({"choices": [{"message": {"content": "first"}}, {"message": {"content": "second"}}]})),
        (2, 400, json.dumps({"error_code": "BAD", "detail": detail})),
        (3, 400, json.dumps({"error_code": "BAD", "detail": json.dumps(detail)})),
        (4, 429, json.dumps({"message": "slow down"})),
        (5, 500, json.dumps({})),
        (6, 400, json.dumps({"detail": "{not json"})),
        (7, 400, json.dumps({"detail": {"other": 1}})),
    ]
    df = spark.createDataFrame(bodies, "id int, status int, body string")
    found = {r.id: r for r in text.flatten_responses(df).collect()}
    assert found[1].content == "first" and found[1].error_code is None
    for i in (2, 3):
        assert (found[i].error_code, found[i].finish_reason) == ("BAD", "input_guardrail_triggered")
        assert (found[i].flagged_input, found[i].flagged_output) == ("violence, self-harm", "pii")
        assert found[i].error_message is None and found[i].content is None
    assert (found[4].error_code, found[4].error_message) == ("N/A", "slow down")
    assert found[5].error_message == "No details available"
    assert found[6].error_message == "{not json" and found[6].finish_reason is None
    assert (found[7].finish_reason, found[7].flagged_input) == ("unknown", "")
