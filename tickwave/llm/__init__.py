"""Training-data operators: quality, archives, mixing, privacy, decontamination,
token files, language modelling, language identification, near duplicates and
learned quality rules.  Nothing else in the library imports this package."""
