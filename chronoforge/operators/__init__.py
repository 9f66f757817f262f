"""DataFrame -> DataFrame operators over one or many time series."""
