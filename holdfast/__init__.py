"""Causal retention analytics as Spark DataFrame jobs.

``functions``  column expressions (no data movement)
``operators``  joins, ranks, quantiles, prefix counts and checks that hold at scale
``sources``    readers, table layout, sinks
``plans``      the reports, effect estimates, learners, evaluation and campaigns
``streaming``  the scoring job as a stream
"""
