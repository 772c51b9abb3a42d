"""Training-data operators: filters, near-duplicate joins, classifiers,
decontamination, packing, sharding and WARC archives, each a function from
DataFrames to DataFrames. Nothing else in the library imports this package."""
