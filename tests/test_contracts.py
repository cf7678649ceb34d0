from dataclasses import replace

import pytest
from pyspark.sql import types as T

from plumbline.contracts import Contract, Field
from plumbline.mdm import ACTIVITY, CUSTOMER, MATERIAL, ORDERS, PRICE_HISTORY, REGISTRY, contract_for, contracts_with_cdc
from plumbline.sinks.files import layout_keys

ALL = [*REGISTRY.values(), ORDERS, ACTIVITY]


@pytest.mark.parametrize("contract", ALL, ids=lambda c: c.table)
def test_shipped_contracts_are_sound(contract):
    assert contract.problems() == []
    assert contract.keys
    assert all(c == c.lower() for c in contract.columns)


def test_registry():
    assert contract_for("MARA") is MATERIAL
    assert contract_for("NOPE") is None
    assert {c.table for c in contracts_with_cdc()} == {"MARA", "KNA1", "LFA1"}
    assert MATERIAL.fqn == "HANA:SAPSR3.MARA"
    assert [len(c.fields) for c in REGISTRY.values()] == [13, 12, 7, 6]


def test_target_schema():
    schema = MATERIAL.target_schema()
    assert schema["gross_weight"].dataType == T.DecimalType(13, 3)
    assert schema["is_deletion_flag"].dataType == T.BooleanType()
    assert not schema["material_number"].nullable


def test_problems_are_found():
    broken = replace(MATERIAL, incremental="changed_on", keys=("material_number", "nope"), partition_column="X")
    text = " ".join(broken.problems())
    assert "changed_on" in text and "nope" in text and "X" in text
    bad = Contract("S", "S", "T", "a", "b", ("k",), (Field("K", "k", "DECIMAL"), Field("L", "l", "WHAT")))
    text = " ".join(bad.problems())
    assert "precision" in text and "WHAT" in text and "not marked as key" in text


def test_tolerances_cannot_relax_keys():
    assert CUSTOMER.with_tolerances(null_drift_points=10.0).null_drift_points == 10.0
    with pytest.raises(ValueError):
        CUSTOMER.with_tolerances(keys=())


def test_layout_keys():
    assert layout_keys(MATERIAL) == ("material_number", ["material_number", "last_changed_on", "_loaded_at"])
    assert layout_keys(REGISTRY["LFA1"])[0] is None
    assert layout_keys(PRICE_HISTORY)[1] == ["material_number", "valid_from", "_loaded_at"]
