"""ebbflow: incremental warehouse toolkit on PySpark.

Entry points:

* ``ebbflow.operators.scd2.scd2_merge`` / ``scd1.scd1_upsert`` - dimension maintenance
* ``ebbflow.operators.facts`` - fact loading (de-dup, pivot, range-join assignment)
* ``ebbflow.plans.bank`` / ``ebbflow.plans.taxi`` - report marts
* ``ebbflow.sources`` / ``ebbflow.sinks`` - incremental reads, versioned writes
* ``ebbflow.streaming.jobs`` - Structured Streaming jobs built on the same operators
* ``ebbflow.session.get_session`` - session with the defaults the operators expect
"""
