"""Reconciliation on sound and on damaged results."""

import pytest

import ledgerfold as lf
import scenarios as sc  # noqa: E402


def verdicts(report):
    return {r.check: r.ok for r in report.collect()}


@pytest.fixture(scope="module")
def sound(spark, sf_dir):
    base, clean = sc.orders_replica(spark, sf_dir), sc.orders_increment(spark, sf_dir, dirty=False)
    return base, clean, lf.merge_closed_key(base, clean)


@pytest.mark.parametrize("dense", [False, True])
def test_sound_result(sound, dense):
    assert verdicts(lf.reconcile(*sound, dense_ids=dense)) == {"open": True, "closed": True}


def test_lost_open_rows(sound):
    base, clean, merged = sound
    damaged = merged.filter("not (eff_to_month = date'5999-12-31' and status = 'N')")
    assert verdicts(lf.reconcile(base, clean, damaged)) == {"open": False, "closed": True}


def test_duplicated_closed_rows(sound):
    base, clean, merged = sound
    damaged = merged.unionByName(lf.closed_slice(merged))
    assert verdicts(lf.reconcile(base, clean, damaged)) == {"open": True, "closed": False}


def test_unmerged_increment(sound):
    base, clean, _ = sound
    assert verdicts(lf.reconcile(base, clean, base)) == {"open": False, "closed": False}


def test_new_entities_forms_agree_on_dense_keys(spark, sf_dir):
    base, new = sc.orders_replica(spark, sf_dir), sc.orders_increment(spark, sf_dir)
    general, dense = lf.new_entities(new, base), lf.new_entities(new, base, dense_ids=True)
    assert general.exceptAll(dense).isEmpty() and dense.exceptAll(general).isEmpty()
    assert not general.isEmpty()
