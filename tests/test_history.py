import datetime as dt


from tests.conftest import values
from tidemark.operators import history as h

D1, D2, D3 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))
END = dt.datetime(9999, 12, 31)
SCHEMA = "id string, name string, city string, phone string"
TRACKED, CARRIED = ["city", "phone"], ["name"]


def load(target, source, when):
    return h.scd2_apply(target, source, "id", TRACKED, CARRIED, when)


def versions(dim):
    return values(dim, "id", "name", "city", "is_current", "valid_from", "valid_to")


def test_changed_new_missing_and_unchanged_keys(rows):
    first = load(None, rows([("a", "A", "X", "1"), ("b", "B", "X", "1"), ("c", "C", "X", "1")], SCHEMA), D1)
    second = load(first, rows([("a", "A2", "X", "1"), ("b", "B2", "Y", "1"), ("d", "D", "X", None)], SCHEMA), D2)
    assert versions(second) == [
        ("a", "A", "X", True, D1, END),  # only an untracked column moved
        ("b", "B", "X", False, D1, D2),
        ("b", "B2", "Y", True, D2, END),
        ("c", "C", "X", True, D1, END),  # missing from the source
        ("d", "D", "X", True, D2, END),
    ]
    assert h.scd2_integrity(second, "id").count() == 0


def test_repeating_a_load_changes_nothing(rows):
    source = rows([("a", "A", "Y", "1")], SCHEMA)
    once = load(load(None, rows([("a", "A", "X", "1")], SCHEMA), D1), source, D2)
    assert versions(load(once, source, D3)) == versions(once)


def test_hash_collision_through_nulls_is_still_a_change(rows):
    first = load(None, rows([("a", "A", None, "X")], SCHEMA), D1)
    second = load(first, rows([("a", "A", "X", None)], SCHEMA), D2)
    assert second.select("row_hash").distinct().count() == 1
    assert second.count() == 2


def test_duplicate_source_rows_give_one_version(rows):
    source = rows([("a", "A", "X", "1"), ("a", "A", "X", "1"), ("a", "A", "Y", "1"), (None, "N", "X", "1")], SCHEMA)
    assert versions(load(None, source, D1)) == [("a", "A", "Y", True, D1, END)]


def test_closed_versions_stay_when_a_key_changes_again(rows):
    dim = None
    for when, city in ((D1, "X"), (D2, "Y"), (D3, "X")):
        dim = load(dim, rows([("a", "A", city, "1")], SCHEMA), when)
    assert versions(dim) == [
        ("a", "A", "X", False, D1, D2), ("a", "A", "X", True, D3, END), ("a", "A", "Y", False, D2, D3),
    ]


def test_change_log_replay(rows):
    log = rows(
        [
            ("a", D1, "upsert", "X"), ("a", D2, "upsert", "X"), ("a", D3, "upsert", "Y"),
            ("b", D1, "upsert", "X"), ("b", D2, "delete", None), ("b", D2, "delete", None), ("b", D3, "upsert", "X"),
            ("c", D1, "delete", None), ("c", D2, "upsert", None),
            ("d", D1, "upsert", "X"), ("d", D3, "delete", "X"),
        ],
        "id string, seq timestamp_ntz, op string, city string",
    )
    dim = h.apply_changes_scd2(log, "id", "seq", ["city"])
    assert values(dim, "id", "city", "is_current", "valid_from", "valid_to") == [
        ("a", "X", False, D1, D3), ("a", "Y", True, D3, END),
        ("b", "X", False, D1, D2), ("b", "X", True, D3, END),
        ("c", None, True, D2, END),
        ("d", "X", False, D1, D3),
    ]


def test_integrity_names_gaps_overlaps_and_missing_current(rows):
    dim = rows(
        [
            ("ok", True, D1, END), ("gap", False, D1, D2), ("gap", True, D3, END),
            ("lap", False, D1, D3), ("lap", True, D2, END), ("none", False, D1, D2),
            ("two", True, D1, None), ("two", True, D2, None),
        ],
        "id string, is_current boolean, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    assert values(h.scd2_integrity(dim, "id")) == [
        ("gap", 1, 0, 1), ("lap", 1, 1, 0), ("none", 0, 0, 0), ("two", 2, 1, 0),
    ]


def test_price_history_and_lookup(rows):
    feed = rows([("p", D1, 5), ("p", D3, 6), ("p", D1, 5)], "id string, ts timestamp_ntz, price int")
    view = h.price_history(feed, "id", "ts", ["price"])
    assert values(view) == [("p", 5, D1, D3), ("p", 6, D3, END)]
    dim = load(load(None, rows([("a", "A", "X", "1")], SCHEMA), D1), rows([("a", "A", "Y", "1")], SCHEMA), D2)
    assert [r.city for r in h.scd2_history(dim, "id", "a").collect()] == ["X", "Y"]
    assert [r.city for r in h.current_rows(dim).collect()] == ["Y"]


