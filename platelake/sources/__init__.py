"""Files, archives, workbooks and option tables to DataFrames."""

from pyspark import cloudpickle

from platelake.sources import archives, files, walk, workbooks

# Workers get the readers' code with each task, so they need no copy of this package.
for _module in (archives, files, walk, workbooks):
    cloudpickle.register_pickle_by_value(_module)
