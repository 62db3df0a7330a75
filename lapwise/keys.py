"""Column names that identify a session and a driver inside it."""

SESSION = ("RACEYEAR", "RACENUMBER")
DRIVER = (*SESSION, "Driver")
