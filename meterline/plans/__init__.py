"""Model layers and reports: functions from DataFrame to DataFrame."""
