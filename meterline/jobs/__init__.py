"""Jobs a user runs. Each is a function; ``python -m meterline.jobs.<name>`` runs it."""
