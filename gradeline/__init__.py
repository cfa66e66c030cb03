"""gradeline: staged refinement of untyped tabular records with Spark DataFrames.

Raw text records are graded step by step: loaded with audit columns, cleaned and
typed, checked row by row, and published. Every operator is a function from
DataFrame to DataFrame built on native Spark expressions.
"""
