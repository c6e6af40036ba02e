"""Multi-step plans: scratch tables, the epoch loop and the complete job."""
