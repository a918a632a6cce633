"""Reading captured responses and tables; writing history, master and exports."""
