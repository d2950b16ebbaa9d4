"""DataFrame -> DataFrame operators. None of them starts a job, except where
the docstring says so."""
