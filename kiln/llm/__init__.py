"""Training-data operators: secrets, token counts, chat formatting, line and near dedup,
language id, pseudonyms, decontamination and packing.

Nothing else in the library imports this subpackage; ``kiln.llm.catalogue`` lists its queries.
"""
