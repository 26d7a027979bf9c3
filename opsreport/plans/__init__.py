"""The report itself and the job that runs it for many dates."""
