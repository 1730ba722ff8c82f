"""The fixed values, stated a second time and by rule where there is one: plans and SQL both take them from one place."""

from gridwarden.functions import values


def test_phase_codes_are_bits():
    letters = {code: "".join(name for name, bit in (("A", 4), ("B", 2), ("C", 1)) if code & bit) for code in range(1, 8)}
    assert values.PHASE_LETTERS == letters
    assert values.PHASE_COUNT == {code: len(text) for code, text in letters.items()}
    assert values.FEEDER_INFO == {code: (code & 1) << 2 | code & 2 | code >> 2 for code in range(1, 8)}


def test_subtypes():
    assert values.MEDIUM_VOLTAGE_PHASES == {subtype: (subtype - 1) % 3 + 1 for subtype in range(1, 7)}
    assert values.LOW_VOLTAGE_PHASES == {subtype: (subtype - 1) % 3 + 1 for subtype in range(1, 10)}
    one, two, three = [1, 2, 3, 4], [9, 10, 13], [5, 6, 7, 8, 11, 12]
    assert values.TRANSFORMER_PHASES == {**dict.fromkeys(one, 1), **dict.fromkeys(two, 2), **dict.fromkeys(three, 3)}
    units = {subtype: 2 if subtype in (9, 10) else 3 if subtype in (11, 12) else 1 for subtype in range(1, 14)}
    assert values.TRANSFORMER_UNITS == units
    assert {k for k, group in values.TRANSFORMER_GROUP.items() if group.startswith("Banco")} == set(values.BANK_SUBTYPES)
    assert values.TRANSFORMER_GROUP[13] == "Bifasico" and set(values.TRANSFORMER_GROUP) == set(range(1, 14))


def test_limits():
    assert (values.SINGLE_PHASE_VOLTAGE, values.MULTI_PHASE_VOLTAGE, values.TAP_RANGE) == (7960, 13800, (1, 5))
    assert (values.TOTALIZER_LOAD, values.MEDIUM_VOLTAGE_LOAD, values.PUBLIC_PROJECT, values.NO_NEUTRAL) == (1, 6, "FOPE", "COO0000")
    assert values.SWITCH_STRUCTURE_LETTER == {1: "S", 2: "D", 3: "E"}
    assert [rule for rule, (category, _) in values.RULE_TITLES.items() if category != "ADMS"] == ["R03", "R04", "R23"]
    assert sorted(values.RULE_TITLES) == [f"R{n:02}" for n in range(1, 24)]
