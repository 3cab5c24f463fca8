import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staywise import functions as fn
from staywise.functions.tails import beta_regularized, gamma_upper
from staywise.operators import cleaning, features
from staywise.values import NULL_TOKENS, TARGET_LABELS


def column(spark, values, expression, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_null_tokens_and_strip(spark):
    assert column(spark, ["nan", "JE ne sais pas", " value "], fn.blank_to_null) == [None, None, "value"]


def test_tokens_are_compared_before_stripping(spark):
    found = column(spark, [" Unknown ", "    ", "unknown", None, " a\t"], fn.blank_to_null)
    assert found == ["Unknown", "", "unknown", None, "a"]


@pytest.mark.parametrize("token", NULL_TOKENS)
def test_every_token_is_null(spark, token):
    assert column(spark, [token], fn.blank_to_null) == [None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=" \tanuUkowNpeit", max_size=9), min_size=1, max_size=40))
def test_strict_cleaning_is_idempotent(spark, values):
    once = lambda c: fn.blank_to_null(c, "strict")
    first = column(spark, values, once)
    assert column(spark, first, once) == first


def test_key_is_the_first_run_of_digits(spark):
    texts = ["EMP-001", "missing", "-5", "12-34", None, "9" * 30]
    assert column(spark, texts, fn.extract_key) == [1, None, 5, 12, None, None]


def test_key_as_a_plain_number(spark):
    found = column(spark, ["7", " 8 ", "EMP-9", None], lambda c: fn.extract_key(c, digits_only=False))
    assert found == [7, 8, None, None]


def test_numbers(spark):
    texts = ["12", " 7 ", "1e3", "-.5", "5.", "12d", "5%", "1,5", "1_0", "0x1F", "nan", "", None, "inf", "-Infinity"]
    want = [12.0, 7.0, 1000.0, -0.5, 5.0] + [None] * 8 + [float("inf"), float("-inf")]
    assert column(spark, texts, fn.to_number) == want


def test_nan_is_null(spark):
    assert column(spark, [float("nan"), 2.0, None], fn.to_number, "x double") == [None, 2.0, None]
    assert column(spark, [float("nan"), 2.0, None], fn.zero_if_missing, "x double") == [0.0, 2.0, 0.0]


def test_percent_always_divides(spark):
    found = column(spark, ["5%", " 1,2 % ", "3", "x", None], fn.parse_percent)
    assert found == pytest.approx([0.05, 0.012, 0.03, None, None])


def test_codes(spark):
    texts = ["1, junior", "-2,5 x", "Junior", None, "level 3.25"]
    assert column(spark, texts, fn.extract_code) == [1.0, -2.5, None, None, 3.25]


def test_target_labels(spark):
    texts = [" OUI ", "1.0", "maybe", None, *TARGET_LABELS]
    assert column(spark, texts, fn.normalize_target) == [1, None, None, None, *TARGET_LABELS.values()]


def test_boolean_target(spark):
    assert column(spark, [True, False, None], fn.normalize_target, "x boolean") == [1, 0, None]


def test_category_keeps_unknown_values(spark):
    found = column(spark, [" FEMME ", " Autre ", None], lambda c: fn.normalize_category(c, {"femme": "F"}))
    assert found == ["F", "Autre", None]


def test_ratio_and_mean(spark):
    df = spark.createDataFrame([(1.0, 0.0, None), (1.0, 4.0, 3.0), (None, None, None)], "a double, b double, c double")
    ratio = [r[0] for r in df.select(fn.safe_ratio(F.col("a"), F.col("b"))).collect()]
    mean = [r[0] for r in df.select(fn.row_mean([F.col(c) for c in "abc"])).collect()]
    assert ratio == [None, 0.25, None]
    assert mean == [0.5, pytest.approx(8 / 3), None]


def test_humanize():
    assert fn.humanize("annees_dans_le_poste") == "Annees dans le poste"


@pytest.mark.parametrize(
    "statistic, dof, p",
    [(3.841458820694124, 1, 0.05), (9.487729036781154, 4, 0.05), (18.307038053275146, 10, 0.05), (0.0, 3, 1.0)],
)
def test_chi2_tail(statistic, dof, p):
    assert gamma_upper(dof / 2, statistic / 2) == pytest.approx(p, rel=1e-9)


@pytest.mark.parametrize(
    "statistic, d1, d2, p",
    [(4.0, 1, 10, 0.0733880348), (4.964602743730711, 1, 10, 0.05), (0.0, 1, 5, 1.0)],
)
def test_f_tail(statistic, d1, d2, p):
    assert beta_regularized(d2 / 2, d1 / 2, d2 / (d2 + d1 * statistic)) == pytest.approx(p, rel=1e-6)


@pytest.mark.parametrize("statistic, d2", [(2.0, 30), (0.3, 7), (9.0, 100)])
def test_f_tail_has_a_closed_form_for_two_degrees(statistic, d2):
    closed = (1 + 2 * statistic / d2) ** (-d2 / 2)
    assert beta_regularized(d2 / 2, 1.0, d2 / (d2 + 2 * statistic)) == pytest.approx(closed, rel=1e-10)


def test_rename_gives_way_to_the_new_key(spark):
    df = spark.createDataFrame([("a", "b")], "eval_number string, id_employee string")
    renamed = cleaning.rename_column(df, "eval_number", "id_employee")
    assert renamed.columns == ["id_employee"] and renamed.first()[0] == "a"
    assert cleaning.rename_column(df, "absent", "x") is df


def test_align_adds_and_orders(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    aligned = cleaning.align_features(df, {"c": "double", "absent": "string", "a": "int"})
    assert aligned.columns == ["c", "absent", "a"] and aligned.first() == (2.0, None, 1)


def test_empty_input_is_refused(spark):
    df = spark.createDataFrame([(None, None)], "a string, b string")
    with pytest.raises(ValueError, match="complete row"):
        cleaning.drop_empty_rows(df, required=True)


def test_feature_columns_fall_back_to_types(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 1)], "id int, a double, b string, y int")
    assert cleaning.feature_columns(df, ["a", "zz"], ["b"], ["id", "y"]) == (["a"], ["b"])
    assert cleaning.feature_columns(df, [], [], ["id", "y"]) == (["a"], ["b"])


def test_dropped_targets_are_counted(spark):
    df = spark.createDataFrame([("oui",), ("?",), ("non",), (None,)], "t string")
    assert sorted(r.t for r in cleaning.normalize_target(df, "t").collect()) == [0, 1]
    assert cleaning.invalid_targets(df, "t").first() == (4, 2)


def test_percent_comes_before_the_general_coercion(spark):
    raw = spark.createDataFrame(
        [("5%", "1000", "0", "2, x", "Femme")],
        "augementation_salaire_precedente string, revenu_mensuel string, annee_experience_totale string, "
        "niveau_education string, genre string",
    )
    row = features.derive_features(raw).first()
    assert row.augementation_salaire_precedente == pytest.approx(0.05)
    assert row.augmentation_par_revenu == pytest.approx(0.00005)
    assert row.niveau_education == 2.0 and row.genre == "F"
    assert "annee_sur_poste_par_experience" not in row.asDict()


def test_level_words_end_as_null(spark):
    raw = spark.createDataFrame([("Junior",), ("3",)], "niveau_hierarchique_poste string")
    found = [r[0] for r in features.derive_features(raw).collect()]
    assert found == [None, 3.0]


def test_split_target(spark):
    df = spark.createDataFrame([(1, "x", "1")], "id int, a string, y string")
    rows, features_of = cleaning.split_target(df, "y", "id")
    assert features_of == ["a"] and rows.first().y == 1
    with pytest.raises(ValueError, match="training table"):
        cleaning.split_target(df, "z")
