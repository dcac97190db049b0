from period_etl.plans.config_run import main

main()
