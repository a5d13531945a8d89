"""billproof: billing-assurance analytics as Spark DataFrame operators.

functions/  column expressions (cleaning, documents, dates, names, keys)
sources/    readers, writers and reference-table builders
operators/  generic relational operators (joins, sets, aggregates, windows, quality)
plans/      domain operators composed from the above (standing, rules, findings, address, revenue, segmentation)
"""
