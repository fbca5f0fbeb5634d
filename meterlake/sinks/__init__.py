"""Writers: append, replace by date, spend update, reports and exports."""
