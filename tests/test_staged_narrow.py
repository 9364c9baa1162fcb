"""What is staged and looked up is no more than the results need."""

from helpers import same

from ordermart.operators.aggregates import STAR_AGGREGATES
from ordermart.operators.clean import clean_tables
from ordermart.operators.star import build_dimension, build_fact, build_star, key_maps
from ordermart.plans.refresh import stage
from ordermart.schemas import DIMENSIONS


def test_columns_of_no_result_are_not_staged(spark, sources):
    comments = {"review_comment_title", "review_comment_message"}
    assert not comments & set(stage(spark, sources).reviews.columns)
    tables = stage(spark, sources, results=False)
    assert not comments & set(tables.reviews.columns)
    assert not {"paid", "priced"} & set(tables.orders.columns)
    assert not {"product_category_name_english", "seller_state"} & set(tables.items.columns)
    star, expected = build_star(tables), build_star(clean_tables(sources))
    for name in star:
        same(star[name], expected[name])
    same(STAR_AGGREGATES["Agg_avg_review_score"](star), STAR_AGGREGATES["Agg_avg_review_score"](expected))


def test_facts_do_not_number_dimensions_again(spark, sources):
    tables = stage(spark, sources, results=False)
    dimensions = {name: build_dimension(tables, name) for name in DIMENSIONS}
    fact = build_fact(tables, key_maps(dimensions))
    assert "Window" not in fact._jdf.queryExecution().optimizedPlan().toString()
