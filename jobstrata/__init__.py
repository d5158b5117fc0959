"""Layered analytics over a table of job postings, written as plain Spark jobs.

``functions``  column expressions (casts, text and flag cleaning, risk tiers)
``operators``  DataFrame -> DataFrame steps (projections, aggregates, percentiles, checks)
``sources``    readers, writers and catalog handling
``plans``      the pipeline, the stand-in input and the registered queries
"""
