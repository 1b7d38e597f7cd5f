"""Sources and sinks: explicit-schema file readers/writers, JDBC, the calendar
generator and the policy feed derived from the driver tables."""
