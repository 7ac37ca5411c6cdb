"""Job plans: column contracts, the three jobs, outputs and sheet views."""
