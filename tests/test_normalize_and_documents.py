"""Nested to flat and back."""

import datetime as dt

import pytest

from merchantry import schemas
from merchantry.operators import documents, normalize

HOME = {"address": "1 Road", "city": "Town", "state": "Ohio", "stateCode": "OH", "postalCode": "1", "coordinates": {"lat": 1.5, "lng": -2.5}}
WORK = {"address": "2 Road", "city": None, "state": None, "stateCode": "TX", "postalCode": "2", "country": "Canada"}
USERS = [
    {"id": 10, "firstName": "A", "username": "a", "birthDate": "1996-5-30", "address": HOME, "bank": {"iban": "X"},
     "company": {"name": "C1", "address": WORK}, "hair": {"color": "red"}},
    {"id": 3, "firstName": "B", "username": "b", "role": "admin", "company": {"name": None, "title": "T"}},
    {"id": 20, "firstName": "C", "username": "c", "address": {}, "bank": {"iban": "Y"}, "company": {"name": "C3", "address": HOME}},
]
PRODUCTS = [
    {"id": 2, "title": "P2", "category": "Home Goods", "tags": ["x", "y"], "images": ["i0", "i1"], "price": 2.675,
     "reviews": [{"rating": 5, "comment": "good", "date": "2024-05-23T08:56:21.618Z"}], "dimensions": {"width": 1.0},
     "meta": {"barcode": "b", "createdAt": "2024-05-23T08:56:21.618Z"}},
    {"id": 1, "title": "P1", "category": "home goods", "tags": [], "images": ["j0"]},
    {"id": 5, "title": "P5", "tags": ["z"]},
]
CARTS = [
    {"id": 7, "userId": 10, "total": 10.0, "products": [{"id": 2, "quantity": 1, "price": 4.0}, {"id": 99, "quantity": 2, "price": 3.0}]},
    {"id": 6, "userId": 99, "total": 0.0, "products": []},
    {"id": 8, "userId": 3, "total": 5.0, "products": [{"id": 1, "quantity": 5, "price": 1.0, "discountPercentage": 10.0}]},
]


def fill(value, dtype):
    """Complete a literal with nulls, so that it fits the declared schema."""
    if value is None:
        return None
    if hasattr(dtype, "fields"):
        return {f.name: fill(value.get(f.name), f.dataType) for f in dtype.fields}
    if hasattr(dtype, "elementType"):
        return [fill(v, dtype.elementType) for v in value]
    return value


def frame(spark, name, data):
    schema = schemas.struct_type(schemas.RAW[name])
    return spark.createDataFrame([fill(r, schema) for r in data], schema)


@pytest.fixture(scope="module")
def flat(spark):
    return {n: df.coalesce(1).cache() for n, df in normalize.normalize(
        frame(spark, "users", USERS), frame(spark, "products", PRODUCTS), frame(spark, "carts", CARTS)
    ).items()}


def test_all_tables_have_their_declared_schema(flat):
    assert set(flat) == set(schemas.NORMALIZED)
    for name, df in flat.items():
        declared = schemas.schema_of("normalized", name)
        assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in declared.fields]


def test_ids_follow_user_order_and_interleave(flat, rows):
    assert rows(flat["users"], "id", "address_id", "bank_id", "company_id", "role") == sorted(
        [(3, None, None, 1, "admin"), (10, 1, 1, 2, "user"), (20, None, 2, 3, "user")], key=repr)
    assert rows(flat["companies"], "id", "name", "title", "address_id") == [(1, "", "T", None), (2, "C1", None, 2), (3, "C3", None, 3)]
    assert rows(flat["addresses"], "id", "city", "state_code", "country") == [
        (1, "Town", "OH", "United States"), (2, "", "TX", "Canada"), (3, "Town", "OH", "United States")]


def test_categories_by_first_appearance(flat, rows):
    assert rows(flat["categories"]) == [(1, "home goods", "home-goods"), (2, "uncategorized", "uncategorized")]
    assert rows(flat["products"], "id", "category_id") == [(1, 1), (2, 1), (5, 2)]


def test_children_run_on(flat, rows):
    assert rows(flat["product_tags"]) == [(1, 2, "x"), (2, 2, "y"), (3, 5, "z")]
    assert rows(flat["product_images"]) == [(1, 1, "j0", 0), (2, 2, "i0", 0), (3, 2, "i1", 1)]
    assert rows(flat["reviews"], "id", "product_id", "rating") == [(1, 2, 5)]
    assert rows(flat["order_items"], "id", "order_id", "product_id") == [(1, 7, 2), (2, 7, 99), (3, 8, 1)]


def test_texts_become_dates_and_timestamps(flat, rows):
    moment = dt.datetime(2024, 5, 23, 8, 56, 21, 618000)
    assert flat["reviews"].first().review_date == moment and rows(flat["products"].filter("id = 2"), "created_at") == [(moment,)]
    assert rows(flat["users"].filter("id = 10"), "birth_date") == [(dt.date(1996, 5, 30),)]


def test_synthetic_orders_are_reproducible(spark, flat, rows):
    again = normalize.normalize_carts(frame(spark, "carts", CARTS).repartition(3))["orders"]
    assert rows(again) == rows(flat["orders"])
    for r in flat["orders"].collect():
        assert r.status in normalize.ORDER_STATUSES and 9 <= r.order_date.hour <= 21
    assert [str(d)[:10] <= "2025-12-01" for (d,) in rows(flat["orders"], "order_date")] == [True] * 3


def test_user_documents(flat):
    docs = {r["_id"]: r for r in documents.user_documents(flat).collect()}
    assert docs[10].address.coordinates.lat == 1.5 and docs[10].company.address.country == "Canada" and docs[10].bank.iban == "X"
    assert docs[3].address is None and docs[3].bank is None and docs[3].company.name == "" and docs[3].company.address is None
    assert docs[20].address is None and docs[20].company.address.city == "Town" and docs[10].hair.color == "red"


def test_product_documents(flat):
    docs = {r["_id"]: r for r in documents.product_documents(flat).collect()}
    assert docs[2].tags == ["x", "y"] and docs[2].images == ["i0", "i1"] and docs[2].reviews[0].comment == "good"
    assert docs[1].tags == [] and docs[1].reviews == [] and docs[5].category.slug == "uncategorized"
    assert all("part" not in d for d in docs.values())


def test_order_documents_drop_unknown_products(flat):
    docs = {r["_id"]: r for r in documents.order_documents(flat).collect()}
    assert [i.product_id for i in docs[7]["items"]] == [2] and docs[7].user.username == "a"
    assert docs[6]["items"] == [] and docs[6].user is None and docs[8]["items"][0].category == "home goods"


def test_images_are_ordered_by_image_order(spark, flat):
    images = spark.createDataFrame([(1, 2, "c", 2), (2, 2, "a", 0), (3, 2, "b", None), (4, None, "lost", 0)], flat["product_images"].schema.simpleString()[7:-1])
    docs = {r["_id"]: r for r in documents.product_documents({**flat, "product_images": images}).collect()}
    assert docs[2].images == ["a", "b", "c"]


@pytest.mark.parametrize("limit", [1, 7, 50, 1000])
def test_oversized_documents_come_in_parts(spark, limit):
    """One parent holds a third of all children; nothing is lost and the order holds across parts."""
    heads = spark.createDataFrame([(i, f"h{i}") for i in range(20)], "k bigint, name string")
    data = [(i, 3 if i % 3 == 0 else 100 + i if i % 11 == 0 else i % 20, f"v{i}") for i in range(600)]
    children = spark.createDataFrame(data, "id bigint, parent bigint, v string").repartition(5)
    lists = {"vs": documents.Children(children, "parent", ["id"], "v")}
    got = documents.embed(heads, "k", lists, limit).orderBy("k", "part").collect()
    assert max(len(r.vs) for r in got) <= max(2 * limit, 1) or limit >= 600
    whole = {}
    for r in got:
        assert (r.name is None) == (r.part > 0)
        whole.setdefault(r.k, []).extend(r.vs)
    assert whole == {k: [v for _, p, v in data if p == k] for k in range(20)}
    assert (max(r.part for r in got) > 0) == (limit < 200)


def test_carts_in_parts_normalize_to_the_same_items(spark, rows):
    schema = schemas.struct_type(schemas.RAW["carts"])
    lines = [{"id": 100 + i, "quantity": i} for i in range(5)]
    whole = [{"id": 1, "products": lines[:2]}, {"id": 2, "products": lines}]
    cut = [(0, whole[0]), (0, {"id": 2, "products": lines[:3]}), (1, {"id": 2, "products": lines[3:]})]
    one = frame(spark, "carts", whole)
    parts = spark.createDataFrame([{**fill(c, schema), "part": p} for p, c in cut], schemas.T.StructType([*schema.fields, schemas.T.StructField("part", schemas.T.IntegerType())]))
    a, b = normalize.normalize_carts(one), normalize.normalize_carts(parts)
    assert rows(a["order_items"]) == rows(b["order_items"]) and rows(a["orders"]) == rows(b["orders"])


def test_round_trip(spark, flat, rows):
    """Documents hold everything the tags, images and reviews tables hold."""
    docs = documents.product_documents(flat).withColumnRenamed("_id", "id")
    for array, table, column in (("tags", "product_tags", "tag"), ("images", "product_images", "image_url")):
        again = normalize.exploded_with_ids(docs, "id", array, column).select("id", "parent_id", column)
        assert rows(again) == rows(flat[table], "id", "product_id", column)
