"""Claims and clinical-record analytics on Spark: DataFrame in, DataFrame out.

Stages over stored zones are in ``clinflow.plans.stages``, the operators they are made of in
``clinflow.operators``, column expressions in ``clinflow.functions``, readers and writers in
``clinflow.sources`` and ``clinflow.sinks``.
"""
