"""Reading and writing files, and the retail views over the driver's tables."""
