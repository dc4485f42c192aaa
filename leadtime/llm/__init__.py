"""Training-data operators: token counts, near-dedup, token files, mixing,
decontamination, secret scans, line dedup, quality rules, language id and
substring dedup.  Nothing else in the library imports this subpackage."""
