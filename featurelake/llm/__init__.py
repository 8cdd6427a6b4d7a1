"""Training-data operators: language ID, near duplicates, quality, dedup, packing, decontamination, chat formatting.

One module per operator. Each works on any frame with the columns its docstring names, ignores further
columns (or carries them, where it says so), and is partition-parallel: what leaves a task is bounded by
what the task read. ``queries`` registers the thin ``opN_*`` queries.
"""
