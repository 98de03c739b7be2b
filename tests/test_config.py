from geoloom.config import DatasetSettings, effective_bbox, validate_config


def test_validation_rules():
    assert validate_config(DatasetSettings()) == []
    bad = DatasetSettings(strategy="x", n_negative=-1, split_method="y", type_budgets={"a": -2})
    assert len(validate_config(bad)) == 5
    assert DatasetSettings(type_budgets={"a": 3, "b": 4}).n_positive_effective == 7


def test_box_precedence():
    assert effective_bbox((1, 2, 3, 4), "maricopa") == (1, 2, 3, 4)
    assert effective_bbox(None, "fresno")[0] == -119.87
    assert effective_bbox(None, "wake") is None and effective_bbox(None, None) is None
