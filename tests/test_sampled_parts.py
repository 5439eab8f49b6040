"""The sampler of x1_negative_samples_parts reads stored positives; they are not derived anew for each of its steps."""

import __spark_entry__


def test_positives_are_derived_once(spark):
    drawn = __spark_entry__.queries()["x1_negative_samples_parts"](spark, __spark_entry__.SMOKE_DIR)
    assert drawn.count() > 0
    assert not [name for name in drawn.inputFiles() if "lineitem" in name or "orders" in name]
