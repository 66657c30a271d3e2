"""Declared flows and the medallion runs built from them."""
