import pytest

from tidemark import MergeOptions, TableSpec, resolve_columns

ITEM = TableSpec("item", key=("id",), identity="id", version="version", computed={"length": "length(name)"},
                 period=("valid_from", "valid_to"), nullable=frozenset({"name", "price"}))
COLUMNS = ["id", "name", "price", "updated", "version", "length", "valid_from", "valid_to"]


def plan(operation="upsert", spec=ITEM, columns=COLUMNS, **options):
    return resolve_columns(spec, MergeOptions(**options), columns, operation)


def test_defaults():
    p = plan()
    assert p.key == ("id",) and not p.null_safe
    assert p.write == ("id", "name", "price", "updated")
    assert p.insert == ("name", "price", "updated")
    assert p.update == ("name", "price", "updated")
    assert p.compare == ("name", "price", "updated")
    assert p.target == tuple(COLUMNS)


def test_identity_is_inserted_when_kept():
    assert plan(keep_identity=True).insert == ("id", "name", "price", "updated")


def test_include_adds_the_key():
    p = plan(include=["price"])
    assert p.write == ("id", "price") and p.update == ("price",) and p.compare == ("price",)
    p = plan(include=["price"], match_on=["name"])
    assert p.write == ("name", "price") and p.update == ("price",)


def test_exclude_is_the_complement():
    assert plan(exclude=["updated"]).update == ("name", "price")


def test_compare_lists_draw_from_all_writable_columns():
    p = plan(include=["price"], include_on_compare=["updated"])
    assert p.compare == ("updated",) and p.update == ("price",)
    assert plan(exclude_on_compare=["updated"]).compare == ("name", "price")


def test_update_lists():
    assert plan(include_on_update=["price"]).update == ("price",)
    assert plan(exclude_on_update=["updated"]).update == ("name", "price")
    assert plan(include_on_update=[]).update == ()
    assert plan(include_on_update=[""]).update == ()


def test_custom_match_updates_the_plain_key():
    spec = TableSpec("doc", key=("code",))
    p = resolve_columns(spec, MergeOptions(match_on=["name"]), ["code", "name", "text"], "upsert")
    assert p.update == ("code", "text")


def test_null_safety_follows_the_declaration():
    assert plan(match_on=["name"]).null_safe
    assert not plan(match_on=["name"], null_safe_keys=False).null_safe
    assert plan(match_on=["updated"], null_safe_keys=True).null_safe


def test_version_can_be_an_ordinary_column():
    assert "version" in plan(ignore_version=True).update


def test_spatial_columns_switch_comparison_off():
    spec = TableSpec("place", key=("id",), spatial=("shape",))
    assert resolve_columns(spec, MergeOptions(), ["id", "shape"], "upsert").compare == ()
    with pytest.raises(ValueError, match="cannot be compared"):
        resolve_columns(spec, MergeOptions(include_on_compare=["id"]), ["id", "shape"], "upsert")


@pytest.mark.parametrize("options, message", [
    (dict(include=["price"], exclude=["name"]), "include and exclude cannot both"),
    (dict(include_on_compare=["price"], exclude_on_compare=["name"]), "include_on_compare and exclude_on_compare"),
    (dict(include_on_update=["price"], exclude_on_update=["name"]), "include_on_update and exclude_on_update"),
    (dict(include=["nope", "nada"]), "nada, nope"),
    (dict(match_on=["nope"]), "match_on of 'item' names unknown columns: nope"),
])
def test_contradictions(options, message):
    with pytest.raises(ValueError, match=message):
        plan(**options)


def test_update_needs_columns_and_a_key():
    with pytest.raises(ValueError, match="no columns to update"):
        plan("update", include_on_update=[])
    with pytest.raises(ValueError, match="needs a key"):
        plan("delete", spec=TableSpec("log"))
    with pytest.raises(ValueError, match="declares no version"):
        plan(spec=TableSpec("log", key=("id",)), check_version=True)
    with pytest.raises(ValueError, match="unknown operation"):
        plan("replace")
