"""Operators: DataFrame -> DataFrame building blocks and the lake writer.

views      reporting views (stage, clean, daily, monthly, hourly, missing,
           variability, quality flags, enriched)
rollup     day-level rollup and the views served from it
normalize  nested API responses -> reading rows (+ rejects)
upsert     partitioned lake write and upsert
planning   incremental-load windows and chunks
state      ingestion state: outcomes, advance, versioned table
metadata   meter listing -> metadata dimension, tracked set
joins      size-checked broadcast joins
"""
