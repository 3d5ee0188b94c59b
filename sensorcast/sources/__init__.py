"""Sources and sinks: raw readings, official files, stored tables, forecasts."""
