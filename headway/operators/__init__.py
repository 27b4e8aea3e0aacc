"""DataFrame -> DataFrame operators over event logs and scenario tables."""
