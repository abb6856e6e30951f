"""Every SURVEY §2 item is covered by a registered job or a test that exists."""

import importlib
import re

from tablejobs.jobs import JOBS
from tablejobs.survey_map import COVERAGE, DRIFT

EXPECTED = ([f"S{i}" for i in range(1, 14)] + [f"D{i}" for i in range(1, 5)]
            + [f"K{i}" for i in range(1, 9)] + [f"T{i}" for i in range(1, 9)]
            + [f"P{i}" for i in range(1, 11)] + [f"A{i}" for i in range(1, 11)]
            + [f"O{i}" for i in range(1, 4)] + ["U1"] + [f"R{i}" for i in range(1, 5)]
            + [f"X{i}" for i in range(1, 11)])


def test_every_inventory_item_is_listed():
    assert sorted(COVERAGE) == sorted(EXPECTED)
    assert all(COVERAGE[item] for item in EXPECTED)


def test_every_reference_exists():
    for item, refs in COVERAGE.items():
        for ref in refs:
            kind, _, target = ref.partition(":")
            if kind == "job":
                assert target in JOBS, (item, ref)
            else:
                module, func = re.match(r"(\w+)\.py::(\w+)$", target).groups()
                assert hasattr(importlib.import_module(f"tests.{module}"), func), (item, ref)


def test_every_job_covers_some_item():
    covered = {ref[4:] for refs in COVERAGE.values() for ref in refs if ref.startswith("job:")}
    assert covered == set(JOBS)


def test_every_drift_item_has_a_test_except_the_metastore_one():
    assert sorted(DRIFT) == sorted(f"V{i}" for i in range(1, 17))
    assert [item for item, refs in DRIFT.items() if not refs] == ["V13"]
    for refs in DRIFT.values():
        for ref in refs:
            module, func = re.match(r"test:(\w+)\.py::(\w+)$", ref).groups()
            assert hasattr(importlib.import_module(f"tests.{module}"), func), ref
