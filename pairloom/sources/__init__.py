"""Reading pairs and stages, writing splits and metric logs."""
